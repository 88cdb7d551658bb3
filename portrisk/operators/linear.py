"""Regularised linear models from sums of products: one aggregation, then a small system per model.

A row's products of (1, inputs, target) are summed by Spark into one vector per key, so the rows
of a key may lie anywhere and are never gathered. What is solved afterwards is as large as a model,
not as its data, and it is solved by column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once a row, however often lambdas below refer to them.

    The optimizer moves a plain column into the lambda that names it, where it would be computed
    for each element; it does not move anything through a generator.
    """
    made = df.withColumn("_once", F.explode(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
    return made.select(*df.columns, *(F.col("_once")[name].alias(name) for name in columns))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def products(values: Column) -> Column:
    """All products values[i] * values[j] with i <= j, row by row of the upper triangle."""
    size = F.size(values)
    return F.flatten(F.transform(values, lambda v, i: F.transform(F.slice(values, i + 1, size - i), lambda w: v * w)))


def at(sums: Column, width: Column, i: Column, j: Column) -> Column:
    """Entry (i, j) of the symmetric matrix whose upper triangle `products` has listed."""
    low, high = F.least(i, j), F.greatest(i, j)
    return F.get(sums, (low * width - (low * (low - 1) / 2) + high - low).cast("int"))


def moments(rows: DataFrame, keys: Sequence[str], inputs: str = "window", target: str = "target") -> DataFrame:
    """keys, width, sums: summed products of (1, inputs, target); entry (0, 0) is the number of rows.

    A sum is combined within each task before it is shuffled. Rows without inputs or target, or
    with a null or non-finite number in them, are left out.
    """
    def number(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    whole = rows.where(F.forall(inputs, number) & number(F.col(target)))
    values = F.concat(F.array(F.lit(1.0)), F.col(inputs), F.array(F.col(target)))
    listed = whole.select(*keys, (F.size(inputs) + 2).alias("width"), array_to_vector(products(values)).alias("products"))
    summed = listed.groupBy(*keys, "width").agg(Summarizer.sum(F.col("products")).alias("sums"))
    return _listed(summed)


def _listed(summed: DataFrame) -> DataFrame:
    return once(summed.withColumnRenamed("sums", "_sums"), sums=vector_to_array("_sums")).drop("_sums")


def added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of several parts of the rows, added up by the keys that are left."""
    summed = parts.withColumn("sums", array_to_vector("sums")).groupBy(*keys, "width").agg(Summarizer.sum(F.col("sums")).alias("sums"))
    return _listed(summed)


def entries(moments_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, i, j, value: the upper triangle, one row per entry."""
    index = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.transform(F.sequence(i, F.col("width") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))
    pairs = F.arrays_zip(F.flatten(index).alias("at"), F.col("sums").alias("value"))
    return moments_.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.at.i", "x.at.j", "x.value")


def centred(moments_: DataFrame) -> DataFrame:
    """Add n, mean (of each input), mean_target, gram (rows) and cross: products of centred values."""
    width, sums = F.col("width"), F.col("sums")
    last, zero = width - 1, F.lit(0)
    inputs = F.sequence(F.lit(1), width - 2)
    means = once(
        moments_, n=F.get(sums, zero), mean_target=at(sums, width, zero, last) / F.get(sums, zero),
        mean=F.transform(inputs, lambda i: at(sums, width, zero, i) / F.get(sums, zero)),
    )
    mean = lambda i: F.get(F.col("mean"), i - 1)
    return once(
        means,
        gram=F.transform(inputs, lambda i: F.transform(inputs, lambda j: at(sums, width, i, j) - F.col("n") * mean(i) * mean(j))),
        cross=F.transform(inputs, lambda i: at(sums, width, i, last) - F.col("n") * mean(i) * F.col("mean_target")),
    )


def solved(system: Column) -> Column:
    """Gauss-Jordan elimination of rows (matrix | right-hand sides); the matrix is positive definite.

    The rows come out with the identity in front and the solutions behind. Such a matrix needs no
    exchange of rows.
    """
    def step(rows: Column, k: Column) -> Column:
        scaled = let(F.get(rows, k), lambda row: F.transform(row, lambda v: v / F.get(row, k)))
        return let(scaled, lambda pivot: F.transform(rows, lambda row, i: F.when(i == k, pivot).otherwise(minus(row, pivot, F.get(row, k)))))

    def minus(row: Column, pivot: Column, factor: Column) -> Column:
        return F.zip_with(row, pivot, lambda v, p: v - factor * p)

    return F.aggregate(F.sequence(F.lit(0), F.size(system) - 1), system, step)


def ridge(systems: DataFrame, strength: Column, chosen: Callable[[Column], Column], prior: Callable[[Column], Column]) -> DataFrame:
    """Add intercept and coefficients of least squares with strength * |coefficients - prior|^2.

    `systems` comes from `centred`. Only inputs whose position (from 0) is `chosen` get a
    coefficient, the others 0; `prior` gives the value each chosen one is drawn to.
    """
    size, zero = F.size("mean"), F.lit(0.0)
    picked = once(systems, _picked=F.filter(F.sequence(F.lit(0), size - 1), chosen))
    picked = once(picked, _prior=F.transform("_picked", prior))
    gram = lambda i, j: F.get(F.get(F.col("gram"), i), j)

    def right(i: Column) -> Column:
        """The right-hand side for the difference to the prior."""
        pairs = F.arrays_zip(F.col("_picked").alias("j"), F.col("_prior").alias("p"))
        return F.get(F.col("cross"), i) - F.aggregate(pairs, zero, lambda s, x: s + F.when(x["p"] == 0, zero).otherwise(gram(i, x["j"]) * x["p"]))

    line = lambda i: F.concat(F.transform("_picked", lambda j: gram(i, j) + F.when(i == j, strength).otherwise(zero)), F.array(right(i)))
    rows = once(once(picked, _system=F.transform("_picked", line)), _solved=solved(F.col("_system")))
    found = F.transform("_solved", lambda row, i: F.element_at(row, -1) + F.get(F.col("_prior"), i))
    rows = once(rows, _found=F.map_from_arrays("_picked", found))
    rows = once(rows, coefficients=F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.try_element_at("_found", i), zero)))
    effect = F.aggregate(F.zip_with("mean", "coefficients", lambda m, c: m * c), zero, lambda s, v: s + v)
    return once(rows, intercept=F.col("mean_target") - effect).drop("_picked", "_prior", "_system", "_solved", "_found")
