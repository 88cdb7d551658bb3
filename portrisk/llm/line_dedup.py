"""Line dedup: repeated runs of lines by distributed prefix doubling, in DataFrame operations only.

A document is the sequence of the names (128-bit hashes) of its lines. As when a suffix array
is built by doubling, runs of 2, 4, 8 ... lines are named by pairs of names, and only positions
whose run is repeated go on. Positions with one name of a run of l lines are an interval of the
suffix array with common prefixes of at least l lines. The intervals of the least depth that
holds enough words contain all deeper ones, so the runs found there, laid over each other, are
the maximal repeated runs; every copy but the first is deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portrisk.llm.mixing import SPACE
from portrisk.llm.names import private
from portrisk.session import freeze

MIN_WORDS = 20
KEY = ("doc_id", "version")


def _version(text: Column) -> Column:
    """Tells apart texts under one id; equal rows are one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _named(*parts: Column) -> Column:
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b"))


def _reach(lines: Column, min_words: int) -> Column:
    """How many of the given lines, from the first, it takes to have min_words words; null if all are too few."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
    step = lambda acc, y: F.when(acc["words"] >= min_words, acc).otherwise(
        F.struct((acc["words"] + y["words"]).alias("words"), (acc["n"] + 1).alias("n"))
    )
    return F.aggregate(lines, start, step, lambda acc: F.when(acc["words"] >= min_words, acc["n"]))


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur at more than one place, with the first place as `first`.

    Names are counted by a partial aggregation. The join back has one small row for each name,
    so the rows of a name that fills a third of all lines are split by adaptive execution.
    """
    place = F.struct(*KEY, "at")
    first = rows.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    return rows.join(first.where("first != last").drop("last"), keys)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, version, line (from 0) of each line to delete, each once.

    Lines without words are passed over. A run of following lines counts if it has `min_words`
    words; it goes if an equal run starts earlier, that is in a document with a smaller
    (doc_id, version) or further up in the same one.
    """
    numbered = F.transform(
        _lines(F.col("text")),
        lambda x, i: F.struct(i.alias("line"), _named(x).alias("name"), F.size(F.array_remove(F.split(x, SPACE), "")).alias("words")),
    )
    texts = docs.where("doc_id is not null").select("doc_id", _version(F.col("text")).alias("version"), F.filter(numbered, lambda x: x["words"] > 0).alias("lines"))
    rows = freeze(texts.select(*KEY, F.posexplode("lines").alias("at", "x")).select(*KEY, "at", "x.*"))
    in_order = Window.partitionBy(*KEY).orderBy("at")
    # equal rows are one document; unbroken stretches of repeated lines are all that matters from here
    level = _repeated(rows, ["name"]).drop("first").withColumn("again", F.lag("at").over(in_order).eqNullSafe(F.col("at"))).where("not again")
    level = level.withColumn("stretch", F.col("at") - F.row_number().over(in_order))
    stretch = Window.partitionBy(*KEY, "stretch").orderBy("at")
    line = F.struct("line", "words")
    level = level.withColumns({
        "ahead": F.collect_list(line).over(stretch.rowsBetween(0, min_words - 1)),
        "behind": F.collect_list(line).over(stretch.rowsBetween(1 - min_words, 0)),
    })
    level = freeze(level.select(*KEY, "at", "name", "ahead", "behind"))
    levels, span = [level.select(*KEY, "at", "name")], 1
    while span * 2 <= min_words:
        after = F.lead(F.struct("at", "name"), span).over(in_order)
        longer = levels[-1].withColumn("after", after).where(F.col("after.at") == F.col("at") + span)
        longer = longer.select(*KEY, "at", _named(F.col("name"), F.col("after.name")).alias("name"))
        levels.append(freeze(_repeated(longer, ["name"]).drop("first")))
        span *= 2
    names = reduce(DataFrame.unionByName, [x.withColumn("k", F.lit(k)) for k, x in enumerate(levels)])
    reach = level.withColumns({"down": _reach(F.col("ahead"), min_words), "up": _reach(F.reverse("behind"), min_words)})
    numbers = lambda part: F.transform(part, lambda y: y["line"])
    down = reach.where("down is not null").select(*KEY, "at", F.col("down").alias("n"), numbers(F.slice("ahead", 1, F.col("down"))).alias("run"))
    up = reach.where("up is not null").select(
        *KEY, (F.col("at") - F.col("up") + 1).alias("at"), F.col("up").alias("n"), numbers(F.slice("behind", F.size("behind") - F.col("up") + 1, F.col("up"))).alias("run")
    )
    runs = down.unionByName(up).dropDuplicates([*KEY, "at", "n"])
    # a run of n lines is named by the two runs of 2^k <= n < 2^(k + 1) lines at its ends
    runs = runs.withColumn("k", F.floor(F.log2("n")).cast("int")).withColumn("tail_at", F.col("at") + F.col("n") - F.expr("shiftleft(1, k)"))
    head = names.withColumnRenamed("name", "head")
    tail = names.select(*KEY, "k", F.col("at").alias("tail_at"), F.col("name").alias("tail"))
    both = freeze(runs.join(head, [*KEY, "k", "at"]).join(tail, [*KEY, "k", "tail_at"]).select(*KEY, "at", "n", "run", "head", "tail"))
    found = _repeated(both, ["n", "head", "tail"]).where(F.struct(*KEY, "at") > F.col("first"))
    return found.select(*KEY, F.explode("run").alias("line")).distinct()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, counts: tuple[str, str] = ("n_lines", "n_deleted")) -> DataFrame:
    """All rows of `docs` with `text` rid of repeated runs, and n_lines, n_deleted (of the row's text).

    Other columns stay as they are, whatever their names; columns that bear the names of the two
    `counts` are replaced by them. A null text stays null and has no
    lines; an empty text has one empty line; rows without an id stay whole; equal rows are one
    document and lose the same lines.
    """
    key, version, lost = private(docs, "id", "version", "lost")
    gone = repeated_lines(docs, min_words).groupBy(*KEY).agg(F.collect_set("line").alias(lost)).select(
        F.col("doc_id").alias(key), F.col("version").alias(version), lost
    )
    out = docs.join(gone, (docs["doc_id"] == F.col(key)) & (_version(docs["text"]) == F.col(version)), "left")
    hit = F.col(lost).isNotNull()
    kept = F.array_join(F.filter(F.transform(_lines(docs["text"]), lambda x, i: F.when(~F.array_contains(lost, i), x)), lambda x: x.isNotNull()), "\n")
    others = [c for c in docs.columns if c.lower() not in {x.lower() for x in counts}]
    columns = [F.when(hit, kept).otherwise(docs[c]).alias(c) if c == "text" else docs[c] for c in others]
    count = F.when(docs["text"].isNull(), 0).otherwise(F.size(_lines(docs["text"])))
    return out.select(*columns, count.cast("long").alias(counts[0]), F.when(hit, F.size(lost)).otherwise(0).cast("long").alias(counts[1]))
