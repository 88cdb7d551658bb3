"""Names for helper columns beside the columns of any table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def private(df: DataFrame, *names: str) -> list[str]:
    """The names, each behind as many underscores as keep it apart from all columns of `df`, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
