"""Named queries over the test tables, each with an independent SQL statement."""

from importlib import import_module

from portrisk.registry.base import ORACLES, QUERIES

for _part in ("sources", "projections", "filters", "joins", "reports", "series", "text"):
    import_module(f"portrisk.registry.{_part}")

__all__ = ["ORACLES", "QUERIES"]
