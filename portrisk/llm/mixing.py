"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portrisk.llm.names import private
from portrisk.session import freeze

SPACE = r"[\x20\x09-\x0D]"
HASH_BITS, STEP_BITS = 60, 12
MAX_REPEATS = 3


def hash_value(column: Column) -> Column:
    """The first 60 bits of the MD5 of a value's text, as a long; equal in every run and engine."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.size(F.array_remove(F.split(text, SPACE), ""))).cast("long")


def source_ranks(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without one task that sees them all."""
    spread = freeze(sources.orderBy(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()))
    ends = [(r["part"], r["n"]) for r in spread.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()]
    before, pairs = 0, []  # one pair for each partition
    for part, n in ends:
        pairs += [F.lit(part), F.lit(before)]
        before += n
    offset = F.create_map(*pairs)[F.col("part")] if pairs else F.lit(0)
    order = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    return spread.withColumn("place", (F.row_number().over(order) - 1 + offset).cast("long")).drop("part")


def targets(sources: DataFrame, weight: Column, cap: float = MAX_REPEATS) -> DataFrame:
    """source, source_size, target: shares of the total by weight, none above cap times its size.

    The excess of capped sources is shared anew by weight among the rest until none is above;
    each pass is one aggregation over the sources and caps at least one more.
    """
    weighed = freeze(source_ranks(sources).withColumn("weight", weight.cast("double")))
    limit = F.col("source_size") * F.lit(float(cap))
    total = float(weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, above = 0.0, -1
    while True:
        capped = limit <= F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
            F.count_if(capped),
        ).first()
        if row[2] == above or not row[1]:
            break
        above, level = row[2], max(level, (total - row[0]) / row[1])
    return weighed.select("source", "source_size", F.least(limit, F.col("weight") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, weight: Column | None = None, cap: int = MAX_REPEATS, size: Column | None = None, key: str = "doc_id") -> DataFrame:
    """Choose how often each document is taken so that each source's words come near its target.

    `weight` is an expression over `place`, the source's number in code point order (null
    last); the default repeats 1, 2, 3. All documents of a source are taken floor(target /
    size) times, and those whose hash lies below a threshold once more. The threshold is
    found from histograms of sizes by source and hash bits: each pass refines only the bucket
    that holds the boundary, and the last bucket goes in if that brings the sum nearer. So
    nothing is sorted, and a source of any size is only summed. Rows with equal keys are
    taken alike.

    Returns key, source, size, source_size, target, copies, taken. Null and empty texts have
    size 0 and are taken with `copies` as the rest (taken 0); a source of only such texts has
    target 0 and copies 0. No rows give no rows; further columns of `docs` do not matter.
    """
    weight = F.col("place") % 3 + 1 if weight is None else weight
    size = word_count(F.col("text")) if size is None else size
    base = freeze(docs.select(F.col(key), F.col("source"), size.alias("size"), hash_value(F.col(key)).alias("hash")))
    goal = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weight, cap)
    share = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-12), F.lit(cap))).otherwise(0)
    # low: hashes below it are in; width: bits of the hash that are still open
    state = freeze(
        goal.withColumn("full", share.cast("long"))
        .withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("full") * F.col("source_size")))
        .withColumns({"low": F.lit(0).cast("long"), "high": F.lit(1 << HASH_BITS).cast("long")})
    )
    for bits in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        bucket = F.shiftright(F.col("hash"), bits)
        open_rows = base.join(state, base["source"].eqNullSafe(state["source"]), "inner").where(
            (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("high"))
        )
        sums = open_rows.groupBy(state["source"], bucket.alias("bucket")).agg(F.sum("size").alias("in_bucket"))
        order = Window.partitionBy("source").orderBy("bucket")  # at most 2^12 buckets a source
        running = sums.withColumn("upto", F.sum("in_bucket").over(order))
        edge = running.join(state.select(F.col("source").alias("s"), "need"), F.col("source").eqNullSafe(F.col("s"))).where("upto >= need and need > 0")
        edge = edge.groupBy("source").agg(F.min_by(F.struct("bucket", "in_bucket", "upto"), "bucket").alias("edge"))
        e = F.col("edge")
        moved = state.alias("a").join(edge.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left").select(
            "a.source", "source_size", "target", "full",
            F.when(e.isNull(), F.col("need")).otherwise(F.col("need") - (e["upto"] - e["in_bucket"])).alias("need"),
            F.when(e.isNull(), F.when(F.col("need") > 0, F.col("high")).otherwise(F.col("low")))
            .otherwise(F.shiftleft(e["bucket"], bits)).alias("low"),
            F.when(e.isNull(), F.when(F.col("need") > 0, F.col("high")).otherwise(F.col("low")))
            .otherwise(F.shiftleft(e["bucket"] + 1, bits)).alias("high"),
            F.when(e.isNull(), F.lit(0)).otherwise(e["in_bucket"]).alias("last"),
        )
        state = freeze(moved)
    # one hash value is left open: in if that is nearer
    chosen = state.select(
        F.col("source").alias("s"), "source_size", "target", "full",
        F.when(F.col("need") * 2 > F.col("last"), F.col("high")).otherwise(F.col("low")).alias("threshold"),
    )
    copies = F.col("full") + F.when((F.col("hash") < F.col("threshold")) & (F.col("full") < cap), 1).otherwise(0)
    return base.join(chosen, F.col("source").eqNullSafe(F.col("s"))).select(
        key, "source", "size", "source_size", "target", copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken")
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes them, with their columns, whatever their names."""
    key, times, turn = private(docs, "id", "copies", "turn")
    chosen = mix(docs, **options).where("copies > 0").groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times))
    out = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col(key)))
    return out.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)


def case_weight(weights: dict[str, float], default: float) -> Column:
    """A weight expression for named sources."""
    return reduce(lambda rest, x: F.when(F.col("source") == x[0], F.lit(x[1])).otherwise(rest), weights.items(), F.lit(default))
