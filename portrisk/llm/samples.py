"""Bounded samples of labelled rows, the only thing a classifier here is fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.session import freeze

SAMPLE_ROWS = 8000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, label of at most `rows` labelled documents, chosen by a hash of the id.

    An id labelled more than once counts with its largest label; ids without a label or a
    document fall away; a repeated document counts once.
    """
    chosen = labels.where(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.min(F.coalesce("text", F.lit(""))).alias("text")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
    return freeze(found.groupBy("doc_id", "label").agg(text))
