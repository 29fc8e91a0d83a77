"""Removal of repeated passages by sliding spans of sentences (op 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, texts_of, words_of
from tidemark.operators.staging import stage

# A sentence keeps its end marks and the white space behind them, so sentences tile the text.
SENTENCE = r"[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+"
PARTS = re.compile(SENTENCE)
EDGES = " \t\r\n"
# Words that a span has at least. Shorter repeats are phrases that independent texts share.
LEAST_WORDS = 20


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, where it may occur many times."""
    return F.transform(F.array(value), body)[0]


def split_sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def spans_of(text: str, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a text: number of the first sentence, length in sentences, hash.

    From every sentence with a word, the shortest run that has ``least_words`` words; none where
    the text ends before. Sentences without a word neither begin a run nor count in its hash.
    """
    spoken, words, hashes = [], [], []
    for i, s in enumerate(PARTS.findall(text)):
        n = len(words_of(s))
        if n:
            spoken.append(i)
            words.append(n)
            hashes.append(xxhash.xxh3_64_digest(s.strip(EDGES).encode()))
    until = np.cumsum([0, *words])
    last = np.searchsorted(until, until[:-1] + least_words)  # sentences up to here have enough words
    first = np.flatnonzero(last < len(until))
    last = last[first]
    place, whole = np.array(spoken, np.int64), b"".join(hashes)
    runs = [xxhash.xxh3_64_intdigest(whole[8 * i : 8 * j]) for i, j in zip(first.tolist(), last.tolist())]
    return place[first], place[last - 1] - place[first] + 1, np.array(runs, np.uint64).view(np.int64)


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """Rows ``doc_id, version, at, n``: spans that occur earlier in the corpus as well.

    A span is the shortest run of consecutive sentences from some sentence on that has ``least_words``
    words (white space around each sentence is ignored; a sentence of so many words is a span by itself).
    ``at`` is the 0-based number of its first sentence in the text, ``n`` its length in sentences,
    ``version`` a hash of the text. The earliest occurrence, by document id, version and
    position, is not returned; all others are. NULL ids come first.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found = [spans_of(t, least_words) for t in texts_of(batch, "text")]
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found]))
            columns = [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)]
            own = [batch.column(c).take(row) for c in ("doc_id", "version")]
            yield pa.RecordBatch.from_arrays([*own, *columns], ["doc_id", "version", "at", "n", "h"])

    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text")
    )
    keys = stage(rows.mapInArrow(cut, f"doc_id {kind}, version long, at long, n long, h long"), "spans")
    # The first place of every repeated hash; a hot passage is combined before the shuffle.
    firsts = (
        keys.groupBy("h")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "version", "at")).alias("first"))
        .filter("times > 1")
        .select("h", "first")
    )
    here = F.struct("doc_id", "version", "at")
    return keys.join(stage(firsts, "firsts"), "h").filter(here > F.col("first")).select("doc_id", "version", "at", "n")


def drop_repeats(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Remove from every text the sentences that a repeated span covers.

    Returns ``doc_id, text, n_sentences, n_removed, removed`` (numbers of the removed
    sentences, ascending) and the columns of ``carry``, one row per input row. The text is what is left, in its old
    order and spacing, possibly empty. NULL text stays NULL, with 0 sentences; texts of
    fewer than ``least_words`` words are unchanged. Rows that repeat an id with the same text
    are one document; with different texts, each loses its own sentences. Extra columns are ignored
    unless carried. An empty table gives no rows.
    """
    spans = repeated_spans(df, doc_id, text, least_words)
    # A set: rows that repeat an id and a text have the same spans.
    starts = spans.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("at", "n"))).alias("starts"))
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("version"),
        F.struct(F.lit(0).alias("_"), *carry).alias("carried"),
    )
    hits = starts.select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"), "starts")
    joined = rows.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version")), "left"
    )
    covered = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform("starts", lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1)))
        )
    )
    parts = split_sentences(F.col("text"))
    # Kept stretches lie between covered ones: slices, not a look-up per sentence.
    numbered = joined.withColumn("removed", F.when(F.col("starts").isNotNull(), covered))
    gaps = _let(
        F.col("removed"),
        lambda r: F.transform(
            F.sequence(F.lit(0), F.size(r)),
            lambda i: F.struct(
                F.when(i == 0, 0).otherwise(F.element_at(r, F.greatest(i, F.lit(1))) + 1).alias("a"),
                F.when(i < F.size(r), F.element_at(r, F.least(i + 1, F.size(r)))).alias("b"),
            ),
        ),
    )
    rest = _let(
        parts,
        lambda p: F.concat_ws(
            "",
            F.flatten(
                F.transform(
                    F.filter(gaps, lambda g: F.coalesce(g["b"], F.size(p)) > g["a"]),
                    lambda g: F.slice(p, g["a"] + 1, F.coalesce(g["b"], F.size(p)) - g["a"]),
                )
            ),
        ),
    )
    return numbered.select(
        "doc_id",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.coalesce(F.regexp_count("text", F.lit(SENTENCE)), F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<long>")).cast("array<int>").alias("removed"),
        *(F.col("carried")[c].alias(c) for c in carry),
    )
