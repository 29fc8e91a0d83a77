"""Language identification: sparse multinomial regression on TF-IDF character n-grams (op 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, fold, is_fold, texts_of
from tidemark.llm.ftrl import Ftrl, Rates
from tidemark.operators.staging import stage

BITS = 14
SIZE = 1 << BITS
STRETCH = 1 << 16  # characters read at a time
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character 1-, 2- and 3-grams of a whole text, lower-cased."""
    total = np.zeros(SIZE, np.int64)
    data = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    for i in range(0, len(data), STRETCH):
        c = data[i : i + STRETCH + 2]
        with np.errstate(over="ignore"):
            one = c * np.uint32(0x9E3779B1)
            two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(31) + c[1:] * np.uint32(0x85EBCA6B)
            three = two[:-1] * np.uint32(0x01000193) + c[2:] * np.uint32(0xC2B2AE35)
            parts = [one[:STRETCH], two[:STRETCH] * np.uint32(0x27D4EB2F), three[:STRETCH] * np.uint32(0x165667B1)]
        total += np.bincount(np.concatenate(parts) >> np.uint32(32 - BITS), minlength=SIZE)
    return total


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of a text: log counts times IDF, of unit length."""
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    return at, values / max(1e-12, float(np.sqrt(values @ values)))


class LanguageModel:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray):
        self.langs, self.idf, self.weights, self.temperature = langs, idf, weights, 1.0

    def scores(self, text: str) -> np.ndarray:
        at, values = tfidf(text, self.idf)
        return values @ self.weights[at]

    def predict(self, text: str) -> tuple[str, float]:
        if not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        s = self.scores(text) / self.temperature
        e = np.exp(s - s.max())
        return self.langs[int(s.argmax())], float(e.max() / e.sum())


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and, per hashed gram, of texts that hold it, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(SIZE, np.int64), 0
        for batch in byte_slices(batches, "text"):
            for text in texts_of(batch, "text"):
                held += gram_counts(text) > 0
                n += 1
        at = np.append(np.flatnonzero(held), SIZE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(np.append(held, n)[at], pa.int64())], ["gram", "n"]
        )

    found = rows.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = np.zeros(SIZE + 1, np.int64)
    for r in found.collect():  # at most one row per hashed gram
        table[r["gram"]] = r["n"]
    return int(table[SIZE]), table[:SIZE]


def train(
    rows: DataFrame,
    langs: dict[str, int],
    per_language: int = 1500,
    shards: int = 6,
    epochs: int = 3,
    rates: Rates = Rates(1.0, 1.0, 0.02, 0.05),
) -> LanguageModel:
    """Fit on ``doc_id, text, lang, calibrates`` rows; IDF over all of them.

    About ``per_language`` rows of each language, chosen by a hash of the id, train (the
    elastic net is FTRL's L1 and L2): every shard by itself, weights averaged. The fold
    that calibrates fits the temperature on as many rows at most.
    """
    names = sorted(langs)
    n, held = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + held)) + 1
    # One scan: the rate of a row's language decides, with the same hash as in thinned().
    shares = F.create_map(*(F.lit(x) for name in names for x in (name, per_language / langs[name])))
    unit = F.xxhash64("doc_id", F.lit(17)).cast("double") / float(2**64) + 0.5
    sample = stage(
        rows.filter(unit < shares[F.col("lang")]).select("doc_id", "text", "lang", "calibrates"), "langs"
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h", kind="stable")
        model = Ftrl(SIZE, len(names), rates)
        rows = [(*tfidf(t, idf), names.index(x)) for t, x in zip(group["text"], group["lang"])]
        target = np.eye(len(names))
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                at, values, lang = rows[i]
                model.learn(at, values, target[lang])
        w = model.weights()
        at, k = np.nonzero(w)
        return pd.DataFrame({"gram": at, "k": k, "w": w[at, k]})

    h = F.xxhash64("doc_id", F.lit(31))
    # Without rows to fit on, those that calibrate have to do.
    only = "not calibrates" if not sample.filter("not calibrates").isEmpty() else "true"
    dealt = sample.filter(only).select("text", "lang", h.alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)))
    parts = dealt.groupBy("shard").applyInPandas(fit, "gram int, k int, w double")
    weights = np.zeros((SIZE, len(names)))
    for r in parts.groupBy("gram", "k").agg(F.sum("w").alias("w")).collect():
        weights[r["gram"], r["k"]] = r["w"] / shards
    model = LanguageModel(names, idf, weights)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            made = pa.array([model.scores(t) for t in texts_of(batch, "text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), made], ["lang", "s"])

    checked = sample.filter("calibrates").select("lang", "text").mapInArrow(scores, "lang string, s array<double>")
    found = checked.collect()  # bounded by the sample; scores only
    if found:
        s = np.array([r["s"] for r in found])
        right = np.array([names.index(r["lang"]) for r in found])
        model.temperature = fit_temperature(s, right)
    return model


def fit_temperature(scores: np.ndarray, right: np.ndarray) -> float:
    """The temperature that makes the right languages likeliest, on a fine logarithmic grid."""

    def loss(t: float) -> float:
        s = scores / t
        top = s.max(axis=1)
        return float((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[np.arange(len(s)), right]).mean())

    return float(min(np.geomspace(0.02, 20, 121), key=loss))


def identify_language(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predict the language of every whole text; ``doc_id, held_out, lang_pred, score``.

    Learned from rows with a language and text outside fold 2 of 4 (fold 3 calibrates); rows
    with NULL id, text or lang teach nothing. ``und`` with score 0 for NULL texts, texts
    without a letter, and all texts if there is nothing to learn from. Repeated rows are
    predicted each; an empty table gives no rows.
    """
    held = is_fold(doc_id, 4, 2).alias("held_out")
    rows = df.select(F.col(doc_id).alias("doc_id"), held, F.col(text).alias("text"), F.col(lang).alias("lang"))
    taught = rows.filter((fold("doc_id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    taught = taught.select("doc_id", "text", "lang", is_fold("doc_id", 4, 3).alias("calibrates"))
    langs = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    shared = df.sparkSession.sparkContext.broadcast(train(taught, langs) if langs else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in byte_slices(batches, "text"):
            made = [(UNKNOWN, 0.0) if model is None else model.predict(t) for t in texts_of(batch, "text")]
            columns = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *columns], ["doc_id", "held_out", "lang_pred", "score"]
            )

    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double")
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, schema)
