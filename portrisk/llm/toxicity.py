"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrisk.llm import samples, textkit
from portrisk.session import freeze

THRESHOLD = 0.7
TREES, DEPTH = 20, 3
LEXICON_FORMS = 4096  # most words and stems a learned lexicon keeps
PRIOR, PRIOR_WEIGHT = 0.1, 2.0
NEAR = 4
# fixed values: insults, and words that address a reader
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers clown scum trash garbage pathetic worthless disgusting filth "
    "imbécile crétin abruti débile connard salaud ordure minable blödmann trottel arschloch abschaum versager dreckig "
    "estúpido imbécil tonto basura escoria asqueroso inútil"
).split()
READER = (
    "you your yours yourself u ur tu toi te vous votre vos ton ta tes du dich dir dein deine euch euer ihr "
    "tú ti usted ustedes vosotros tuyo contigo"
).split()
NAMES = (
    "log_words", "insults", "insult_count", "max_rate", "mean_rate_top", "sure_forms", "likely_forms", "sure_density", "reader_density",
    "reader_near", "capitals", "exclaims", "signs", "obfuscated", "digits_in_words",
)
_LEET = textkit._LOWER.copy()
for _sign, _letter in zip("013457@$!", "oleastasi", strict=True):  # fixed: signs that stand for letters
    _LEET[ord(_sign)] = ord(_letter)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_INNER = _LETTER | _DIGIT
_INNER[[ord("@"), ord("$")]] = True
_LIST_HASHES: dict = {}


def _hash_list(words: list[str]) -> np.ndarray:
    data = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    values = textkit.LOWER_VALUES[np.frombuffer(data, np.uint8)]
    return np.unique(textkit.range_hash(textkit.prefix_sums(values), np.concatenate([[0], ends[:-1]]), ends))


def _isin(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _cores(data: np.ndarray, offsets: np.ndarray):
    """Words without the signs around them: start, end (equal if nothing is left), text number."""
    starts, ends, doc = textkit.words(data, offsets)
    inner = np.flatnonzero(_LETTER[data] | _DIGIT[data])
    if not len(inner):
        return starts, starts, doc, ends
    a, b = np.searchsorted(inner, starts), np.searchsorted(inner, ends) - 1
    some = b >= a
    left = np.where(some, inner[np.minimum(a, len(inner) - 1)], starts)
    right = np.where(some, inner[np.maximum(b, 0)] + 1, starts)
    return left, right, doc, ends


def forms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word as read (lower case, signs undone) and of its first six bytes and eight."""
    left, right, doc, _ = _cores(data, offsets)
    if not len(left):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = textkit.prefix_sums(textkit.BYTE_VALUES[_LEET[data]])
    whole = right > left
    parts = [(doc[whole], textkit.range_hash(sums, left[whole], right[whole]))]
    for width in (6, 8):
        longer = right - left > width
        parts.append((doc[longer], textkit.range_hash(sums, left[longer], left[longer] + width) ^ np.uint64(width)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Lexicon:
    """Words and stems with how many of the labelled texts that hold them are toxic."""

    def __init__(self, hashes: np.ndarray, toxic: np.ndarray, texts: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.toxic, self.texts = hashes[order], toxic[order].astype(float), texts[order].astype(float)

    def rates(self, values: np.ndarray, own: np.ndarray | None) -> np.ndarray:
        """Share of toxic texts for each form; own: the label of the form's text, left out of the count (-1: none)."""
        if not len(self.hashes):
            return np.full(len(values), PRIOR)
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        toxic, texts = self.toxic[at], self.texts[at]
        if own is not None:
            toxic, texts = toxic - (own == 1), texts - (own >= 0)
        rate = (toxic + PRIOR * PRIOR_WEIGHT) / (texts + PRIOR_WEIGHT)
        return np.where(self.hashes[at] == values, rate, PRIOR)


def dense(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, labels: np.ndarray | None = None) -> np.ndarray:
    """One row of NAMES for each text; labels: those of texts that the lexicon was counted on."""
    n = len(offsets) - 1
    out = np.zeros((n, len(NAMES)))
    left, right, doc, ends = _cores(data, offsets)
    if not len(left):
        return out
    if not _LIST_HASHES:
        _LIST_HASHES.update(insults=_hash_list(INSULTS), reader=_hash_list(READER))
    plain = textkit.range_hash(textkit.prefix_sums(textkit.LOWER_VALUES[data]), left, right)
    read = textkit.range_hash(textkit.prefix_sums(textkit.BYTE_VALUES[_LEET[data]]), left, right)
    total = np.bincount(doc, minlength=n)
    words = np.maximum(total, 1)
    share = lambda flag: np.bincount(doc, flag, minlength=n) / words
    insult, reader = _isin(read, _LIST_HASHES["insults"]), _isin(plain, _LIST_HASHES["reader"])
    form_doc, form = forms(data, offsets)
    own = labels[form_doc] if labels is not None else None
    rate = lexicon.rates(form, own)
    known = rate != PRIOR
    form_doc, form, rate = form_doc[known], form[known], rate[known]
    order = np.lexsort((form, form_doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (form_doc[order][1:] != form_doc[order][:-1]) | (form[order][1:] != form[order][:-1])
    distinct_doc, distinct_rate = form_doc[order][fresh], rate[order][fresh]
    top = np.full(n, PRIOR)
    np.maximum.at(top, form_doc, rate)
    near = np.zeros(len(doc), bool)
    for gap in range(1, NEAR + 1):
        same = doc[gap:] == doc[:-gap]
        near[gap:] |= same & reader[:-gap]
        near[:-gap] |= same & reader[gap:]
    rude = insult.copy()
    rude |= lexicon.rates(read, labels[doc] if labels is not None else None) > 0.6
    sums = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    upper = sums((data >= 65) & (data <= 90))
    letters, digits, inner = sums(_LETTER[data]), sums(_DIGIT[data]), sums(_INNER[data])
    at = offsets[:-1], offsets[1:]
    chars = np.maximum(at[1] - at[0], 1)
    mixed = (letters[right] - letters[left] > 0) & (right - left > letters[right] - letters[left])
    out[:, 0] = np.log1p(total)
    out[:, 1] = share(insult)
    out[:, 2] = np.bincount(doc, insult, minlength=n)
    out[:, 3] = top
    high = distinct_rate > 0.35
    count = np.bincount(distinct_doc[high], minlength=n)
    out[:, 4] = np.bincount(distinct_doc[high], distinct_rate[high], minlength=n) / np.maximum(count, 1)
    out[:, 5] = np.bincount(distinct_doc[distinct_rate > 0.75], minlength=n)
    out[:, 6] = np.bincount(distinct_doc[distinct_rate > 0.5], minlength=n)
    out[:, 7] = np.bincount(form_doc[rate > 0.6], minlength=n) / words
    out[:, 8] = share(reader)
    out[:, 9] = share(rude & near)
    out[:, 10] = (upper[at[1]] - upper[at[0]]) / np.maximum(letters[at[1]] - letters[at[0]], 1)
    marks = sums(data == ord("!"))
    out[:, 11] = (marks[at[1]] - marks[at[0]]) / chars
    out[:, 12] = (chars - (inner[at[1]] - inner[at[0]])) / chars
    out[:, 13] = share(mixed)
    out[:, 14] = share((digits[right] - digits[left] > 0) & mixed)
    return out


def _learn_lexicon(rated: DataFrame) -> Lexicon:
    """Forms that are held by toxic texts more often than chance, the LEXICON_FORMS clearest of them."""
    schema = "form long, toxic long, texts long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            label = rows.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in textkit.text_chunks(rows.column(0)):
                doc, form = forms(data, offsets)
                order = np.lexsort((form, doc))
                doc, form = doc[order], form[order]
                fresh = np.ones(len(doc), bool)
                fresh[1:] = (doc[1:] != doc[:-1]) | (form[1:] != form[:-1])
                value, back = np.unique(form[fresh], return_inverse=True)
                toxic = np.bincount(back, label[i:j][doc[fresh]] > 0, minlength=len(value))
                yield textkit.batch(schema, value.view(np.int64), toxic.astype(np.int64), np.bincount(back, minlength=len(value)))

    share = rated.agg(F.avg("label")).first()[0] or 0.0
    counts = rated.select("text", "label").mapInArrow(count, schema).groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"))
    surplus = (F.col("toxic") - share * F.col("texts")) / F.sqrt(share * F.col("texts") + 0.1)
    best = counts.where((F.col("toxic") >= 3) & (surplus > 3)).orderBy(surplus.desc(), "form").limit(LEXICON_FORMS).toArrow()
    form, toxic, texts = (best.column(c).to_numpy() for c in ("form", "toxic", "texts"))
    return Lexicon(form.view(np.uint64), toxic, texts)


def _with_features(docs: DataFrame, sent, labelled: bool) -> DataFrame:
    """doc_id, features and, if labelled, label."""
    schema = "doc_id long, features array<double>" + (", label int" if labelled else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        for rows in batches:
            label = rows.column(2).to_numpy(zero_copy_only=False) if labelled else None
            for i, j, data, offsets in textkit.text_chunks(rows.column(1)):
                values = dense(data, offsets, lexicon, None if label is None else label[i:j])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(NAMES)), pa.int32()), pa.array(values.ravel()))
                yield textkit.batch(schema, rows.column(0).slice(i, j - i), flat, *([label[i:j].astype(np.int32)] if labelled else []))

    return docs.select("doc_id", "text", *(["label"] if labelled else [])).mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3; fold 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs` (doc_id, text).

    Learns from at most `rows` labelled rows outside the held-out fold: a lexicon of words and
    stems, trees over NAMES (a labelled text's own label is left out of its lexicon counts),
    and a monotone map from tree output to the share of toxic texts, fitted on a fifth of the
    sample that the trees did not see. Null and empty texts get the score of a text without
    words; every row is scored on its own; labels of one class only give that class's share.
    """
    spark = docs.sparkSession
    usable = labels.where(fold(F.col("doc_id")) != 1)
    rated = samples.labelled_sample(docs, usable, "toxic", rows)
    spread = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5))
    held = fold(F.col("doc_id")) == 1
    found = rated.agg(F.count("*"), F.coalesce(F.avg("label"), F.lit(0.0)), F.count_if((spread > 0) & (F.col("label") > 0)), F.count_if((spread > 0) & (F.col("label") == 0)), F.count_if(spread == 0)).first()
    if not (found[2] and found[3] and found[4]):
        score = F.lit(float(found[1]))
        return docs.select("doc_id", held.alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    sent = spark.sparkContext.broadcast(_learn_lexicon(rated))
    vector = lambda df: df.select(*[c for c in df.columns if c != "features"], *[F.col("features")[i].alias(x) for i, x in enumerate(NAMES)])
    to_vector = VectorAssembler(inputCols=list(NAMES), outputCol="features")
    sample = to_vector.transform(vector(freeze(_with_features(rated, sent, True)))).select("doc_id", "label", "features")
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(sample.where(spread > 0))
    raw = vector_to_array("probability")[1].alias("raw")
    seen = trees.transform(sample.where(spread == 0)).select(raw, F.col("label").cast("double").alias("label"))
    ladder = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calm").fit(seen)
    scored = trees.transform(to_vector.transform(vector(_with_features(docs, sent, False)))).select("doc_id", raw)
    scored = ladder.transform(scored)
    # the trees' own order breaks the ties of the steps
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.99 * F.col("calm") + 0.01 * F.col("raw")))
    return scored.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
