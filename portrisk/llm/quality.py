"""Quality classifier: ordinal cumulative-link regression on hashed text.

One weight vector is shared by all grades; ordered thresholds cut its score:
P(grade > j) = sigmoid(w.x - theta_j). Expected grade and the tail probability of a chosen
grade come from the same fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.llm import samples, textkit

BUCKETS = 1 << 15
SCALE = 40.0  # features are shares of a text's tokens; this brings them near 1
STEPS, PENALTY = 150, 1e-4
KEEP_FROM, KEEP_TAIL = 1, 0.5
# byte classes of word shapes: lower, upper, digit, other bytes as they are
_SHAPE = np.arange(256)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each token of each text.

    For every word: the word itself, its shape (runs of lower, upper, digits and signs, the
    last sign kept), and whether it repeats the word before it.
    """
    starts, ends, doc = textkit.words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = textkit.range_hash(textkit.prefix_sums(textkit.LOWER_VALUES[data]), starts, ends)
    kind = _SHAPE[data]
    head = np.ones(len(data), bool)
    head[1:] = kind[1:] != kind[:-1]
    head[starts] = True
    at = np.concatenate([[0], np.cumsum(head)])
    shape = textkit.range_hash(textkit.prefix_sums(textkit.BYTE_VALUES[kind[head]]), at[starts], at[ends])
    same = np.zeros(len(word), np.uint64)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    flag = textkit.mix(same + np.uint64(77))
    tokens = np.concatenate([word, shape ^ np.uint64(0xA5A5), flag])
    return np.tile(doc, 3), (tokens >> np.uint64(40)).astype(np.int64) % BUCKETS


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for every threshold j, in columns."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, bucket = features(data, offsets)
        n = len(offsets) - 1
        total = np.maximum(np.bincount(doc, minlength=n), 1)
        return np.bincount(doc, self.weights[bucket], minlength=n) * SCALE / total


def fit(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, grades: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> OrdinalModel:
    """Maximum likelihood by Adam; thresholds are a first one and positive gaps, so they stay ordered."""
    n, levels = max(1, len(grades)), int(grades.max(initial=0)) + 1
    above = np.array([(grades > j).mean() if len(grades) else 0.5 for j in range(max(1, levels - 1))]).clip(0.01, 0.99)
    cuts = np.log((1 - above) / above)
    raw = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    params = np.concatenate([np.zeros(BUCKETS), raw])
    first, second = np.zeros_like(params), np.zeros_like(params)

    def thresholds(raw: np.ndarray) -> np.ndarray:
        return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])

    for step in range(1, steps + 1):
        weights, raw = params[:BUCKETS], params[BUCKETS:]
        theta = thresholds(raw)
        score = np.bincount(doc, weights[bucket] * value, minlength=n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            upper = 1 / (1 + np.exp(np.clip(score - edges[grades + 1], -40, 40)))
            lower = 1 / (1 + np.exp(np.clip(score - edges[grades], -40, 40)))
        lower[grades == 0], upper[grades == levels - 1] = 0.0, 1.0
        mass = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        pull = (d_upper - d_lower) / n  # of the loss by the score
        grad = np.concatenate([np.bincount(bucket, pull[doc] * value, minlength=BUCKETS) + penalty * weights, np.zeros(len(raw))])
        by_theta = np.array([(d_lower[grades == j + 1].sum() - d_upper[grades == j].sum()) / n for j in range(len(theta))])
        grad[BUCKETS] = by_theta.sum()
        for j in range(1, len(raw)):
            grad[BUCKETS + j] = by_theta[j:].sum() * np.exp(raw[j])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params = params - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(params[:BUCKETS], thresholds(params[BUCKETS:]))


def train(docs: DataFrame, ratings: DataFrame, grade: str = "grade", rows: int = samples.SAMPLE_ROWS) -> OrdinalModel:
    """Fit on a sample of at most `rows` rated documents; `ratings` has doc_id and whole grades from 0.

    The tokens are counted on the executors; the driver gets (text, bucket, count) of the
    sample, about 10 MB for each thousand documents. Without rated rows all texts score alike.
    """
    rated = samples.labelled_sample(docs, ratings, grade, rows)
    schema = "label int, bucket array<long>, count array<long>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i, j, data, offsets in textkit.text_chunks(rows.column(1)):
                doc, bucket = features(data, offsets)
                pair, n = np.unique(doc * BUCKETS + bucket, return_counts=True)
                cut = np.searchsorted(pair // BUCKETS, np.arange(j - i + 1))
                spans = [slice(cut[x], cut[x + 1]) for x in range(j - i)]
                yield textkit.batch(schema, rows.column(0).slice(i, j - i).cast("int32"), [pair[s] % BUCKETS for s in spans], [n[s] for s in spans])

    got = rated.orderBy("doc_id").select("label", "text").mapInArrow(count, schema).toArrow()
    lengths = np.array([len(x) for x in got.column("bucket")], np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    flat = [got.column(c).combine_chunks().flatten().to_numpy() if len(lengths) else np.zeros(0, np.int64) for c in ("bucket", "count")]
    totals = np.maximum(np.bincount(doc, flat[1], minlength=len(lengths)), 1)
    return fit(doc, flat[0], flat[1] * SCALE / totals[doc], got.column("label").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: OrdinalModel, keep_from: int = KEEP_FROM, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """doc_id, expected_grade, tail (probability of grade `keep_from` or more), keep (tail >= keep_tail) of every row.

    Null and empty texts have no tokens and score by the thresholds alone; every row is
    scored by itself, so repeated rows get equal scores.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, expected_grade double, tail double, keep boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for rows in batches:
            for i, j, data, offsets in textkit.text_chunks(rows.column(1)):
                tails = model.tails(model.score(data, offsets))
                tail = tails[:, min(keep_from, tails.shape[1]) - 1]
                yield textkit.batch(schema, rows.column(0).slice(i, j - i), tails.sum(axis=1), tail, tail >= keep_tail)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 poor, 1 sound but toxic, 2 sound."""
    sound = F.col("quality") > 0
    grade = F.when(F.col("quality").isNull(), F.lit(None)).when(~sound, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def keep_good(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """The rows of `docs` whose own text is rated good enough, with their columns.

    The decision is made batch by batch beside the text, without a join.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, ratings))
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for rows in batches:
            for i, j, data, offsets in textkit.text_chunks(rows.column(at)):
                tails = model.tails(model.score(data, offsets))
                good = tails[:, min(KEEP_FROM, tails.shape[1]) - 1] >= KEEP_TAIL
                yield rows.slice(i, j - i).filter(pa.array(good))

    return docs.mapInArrow(run, schema)
