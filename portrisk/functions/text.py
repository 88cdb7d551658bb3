"""Page and article text, with native string functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.session import freeze

# --- fixed values: page markup ------------------------------------------------
# parts of a page that are not text
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_PARAGRAPH = r"(?i)<p(?:\s[^>]*)?>"
# a paragraph ends at its own end tag or at the end of a block around it
_BLOCK_END = r"(?i)</(?:p|div|article|section|main|body|html|td|li|footer|nav)\s*>"
_TAG = r"(?s)<[^>]*>"
# named characters, the ampersand last so nothing is decoded twice
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'",
    "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&",
}
# --- fixed values: sentences and words -----------------------------------------
_SENTENCE_END = r"[.!?]+[ \t\r\n]+|[\r\n]+"
_NOT_WORD = r"[ \t\r\n.,;:!?\"'()\[\]{}<>|&%$#*/=+_-]+"

_OPEN, _CLOSE = "\u0001", "\u0002"
# words above this part of all tokens are at most as many, and their list is broadcast
HEAVY_SHARE = 200_000


def extract_paragraphs(html: str | Column) -> Column:
    """Text of the paragraphs of a page, joined by blanks.

    Rule: comments, scripts and styles are removed. A paragraph runs from its
    start tag to the next paragraph start, its end tag or the end of the block
    around it, so an unclosed paragraph does not swallow its successors. Tags
    inside are dropped and named characters decoded.
    """
    html = F.col(html) if isinstance(html, str) else html
    marked = F.regexp_replace(html, _HIDDEN, "")
    marked = F.regexp_replace(marked, _PARAGRAPH, _OPEN)
    marked = F.regexp_replace(marked, _BLOCK_END, _CLOSE)
    marked = F.regexp_replace(marked, _TAG, "")
    pieces = F.split(marked, _OPEN)
    paragraphs = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.substring_index(p, _CLOSE, 1),
    )
    text = F.array_join(paragraphs, " ")
    for name, character in _ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def slice_content(
    df: DataFrame, start: int = P.SUMMARY_SLICE[0], stop: int = P.SUMMARY_SLICE[1],
    column: str = "contenturl",
) -> DataFrame:
    """Characters start..stop (zero-based, end excluded) of the article text."""
    return df.withColumn(column, F.substring(F.col(column), start + 1, stop - start))


def split_sentences(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.split(column, _SENTENCE_END)


def words(text: str | Column) -> Column:
    """Lower-case words of a text as an array."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(column), _NOT_WORD), lambda w: w != "")


def _with_frequency(tokens: DataFrame) -> DataFrame:
    """Add the corpus frequency of the word to every token row (word).

    The list of words is broadcast, or the heavy ones if it is too long: tokens then stay where their text
    is. The rest, which is shuffled by word, holds no heavy word, so no word's rows fill a task.
    """
    frequency = freeze(tokens.groupBy("word").agg(F.count(F.lit(1)).alias("frequency")))
    distinct, every = frequency.agg(F.count(F.lit(1)), F.sum("frequency")).first()
    if distinct <= HEAVY_SHARE:
        return tokens.join(F.broadcast(frequency), "word")
    is_heavy = F.col("frequency") * HEAVY_SHARE > every
    heavy = F.broadcast(frequency.where(is_heavy))
    rest = tokens.join(heavy.select("word"), "word", "left_anti")
    return tokens.join(heavy, "word").unionByName(rest.join(frequency.where(~is_heavy), "word"))


def sentence_scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Mean corpus frequency of the words of every sentence that has words.

    Texts are split again for every use, which is cheaper than to store or shuffle their words: what
    is shuffled is a sum per sentence and task, and the few words that are not broadcast.
    """
    tokens = df.select(
        key, F.posexplode(split_sentences(text)).alias("position", "sentence")
    ).select(key, "position", F.explode(words("sentence")).alias("word"))
    score = F.sum("frequency") / F.count(F.lit(1))
    return _with_frequency(tokens).groupBy(key, "position").agg(score.alias("score"))


def extractive_summary(
    df: DataFrame, k: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The ``k`` most typical sentences of each text, in reading order.

    Typical means a high mean corpus frequency of the words; ties go to the
    earlier sentence. ``key`` identifies a text. Texts without words get no row.
    """
    best = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("position"))
    chosen = (
        sentence_scores(df, key, text)
        .withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") <= k)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("position")).alias("_at"))
    )
    # one split per text: positions are looked up while filtering its sentences
    picked = F.filter(split_sentences(text), lambda _, at: F.array_contains("_at", at))
    summary = F.array_join(F.transform(picked, lambda s: F.trim(s)), " ")
    return df.join(chosen, key).select(key, summary.alias("summary"))
