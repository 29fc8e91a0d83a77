"""Toxicity scores: FTRL-proximal logistic regression on word n-grams and skip-grams (op 7)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, fold, mix64, texts_of, thinned
from tidemark.llm.ftrl import Ftrl, Rates
from tidemark.operators.staging import stage

TOKEN = re.compile(r"\w+")
BETWEEN = re.compile(r"\W")
BIAS = np.int64(0)
# Texts are read in stretches of about so many characters, which bounds the memory of a very long text.
STRETCH = 1 << 20
# Grams that are numbered at once, and coordinates whose weights are taken at once.
BLOCK = 1 << 18


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the words, word pairs and pairs that skip one word, by stretches.

    A stretch ends between two words and begins with the last two words of the one before.
    """
    text, start, last = text.lower(), 0, []
    while start < len(text):
        gap = BETWEEN.search(text, start + STRETCH)
        stop = gap.end() if gap else len(text)
        words = last + TOKEN.findall(text, start, stop)
        start, last = stop, words[-2:]
        h = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        with np.errstate(over="ignore"):
            pair = mix64(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x100000001B3))
            skip = mix64(h[:-2] * np.uint64(5) + h[2:] * np.uint64(0x10000000233))
        yield np.concatenate([h, pair, skip]).view(np.int64)


def features(text: str) -> np.ndarray:
    """Distinct gram hashes of a whole text, sorted."""
    parts = [np.unique(g) for g in gram_hashes(text)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)


class SparseWeights:
    """Non-zero weights by gram hash. A table of the hashes' low bits rules most grams out."""

    BITS = 20

    def __init__(self, weights: dict[int, float]):
        self.bias = weights.get(int(BIAS), 0.0)
        keys = sorted(k for k in weights if k != int(BIAS))
        self.keys = np.array(keys, np.int64)
        self.values = np.array([weights[k] for k in keys])
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[self.keys & ((1 << self.BITS) - 1)] = True

    def score(self, text: str) -> float:
        found = []
        for g in gram_hashes(text):
            g = g[self.maybe[g & ((1 << self.BITS) - 1)]]
            if not len(g):
                continue
            at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
            found.append(np.unique(at[self.keys[at] == g]))
        total = self.bias + (self.values[np.unique(np.concatenate(found))].sum() if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


class Texts(Sequence):
    """Values of an Arrow column in a given order, decoded one at a time."""

    def __init__(self, column: pa.ChunkedArray, order: np.ndarray):
        self.column, self.order = column, order

    def __len__(self) -> int:
        return len(self.order)

    def __getitem__(self, i: int) -> str | None:
        return self.column[int(self.order[i])].as_py()


class Numbering:
    """Numbers up to ``most`` grams in the order in which blocks of them come."""

    def __init__(self, most: int):
        # Only pages in use take memory.
        self.hashes, self.numbers, self.count = np.empty(most + 1, np.int64), np.empty(most + 1, np.int32), 1
        self.hashes[0], self.numbers[0] = BIAS, 0

    @property
    def names(self) -> np.ndarray:
        return self.hashes[: self.count]

    def of(self, grams: np.ndarray) -> np.ndarray:
        fresh = np.unique(grams)
        fresh = fresh[self.names[np.minimum(np.searchsorted(self.names, fresh), self.count - 1)] != fresh]
        at = np.searchsorted(self.names, fresh) + np.arange(len(fresh))
        # From the end on, names make room where they are: a second table is not needed.
        for stop in range(self.count, 0, -BLOCK):
            start = max(0, stop - BLOCK)
            names, numbers = self.hashes[start:stop].copy(), self.numbers[start:stop].copy()
            to = np.searchsorted(fresh, names) + np.arange(start, stop)
            self.hashes[to], self.numbers[to] = names, numbers
        self.hashes[at] = fresh
        self.numbers[at] = np.arange(self.count, self.count + len(fresh))
        self.count += len(fresh)
        return self.numbers[np.searchsorted(self.names, grams)]

    def places(self) -> np.ndarray:
        """The place among the sorted names of each number."""
        places = np.empty(self.count, np.int32)
        places[self.numbers[: self.count]] = np.arange(self.count, dtype=np.int32)
        return places


def admitted(texts: Sequence[str | None], least: int = 2, bits: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams that (but for chance) ``least`` of the texts hold: ``names, at, ends``.

    ``names`` are their sorted hashes and that of the bias; text ``i`` holds those at the
    places ``at[ends[i]:ends[i + 1]]``. Texts are read twice, first to count grams by the low
    bits of their hashes in one small table, so memory follows the admitted grams, in flat
    arrays, and not the number of different ones. Hashes are numbered by blocks, so that a
    gram of a text takes 4 bytes, not the 8 of its hash and more to sort them.
    """
    mask, seen, most = (1 << bits) - 1, np.zeros(1 << bits, np.uint8), 0
    for t in texts:
        grams = features(t or "")
        low = np.unique(grams & mask)
        seen[low] += seen[low] < 255
        most += len(grams)
    at, ends = np.empty(most, np.int32), np.zeros(len(texts) + 1, np.int64)  # only pages in use take memory
    numbering, block, start = Numbering(most), [], 0
    for i, t in enumerate(texts):
        grams = features(t or "")
        block.append(grams[seen[grams & mask] >= least])
        ends[i + 1] = ends[i] + len(block[-1])
        # Blocks grow with the names, which move once a block.
        if ends[i + 1] - start >= max(BLOCK, numbering.count // 8) or i + 1 == len(texts):
            at[start : ends[i + 1]] = numbering.of(np.concatenate(block))
            block, start = [], ends[i + 1]
    at, places = at[: ends[-1]], numbering.places()
    for i in range(0, len(at), BLOCK):
        at[i : i + BLOCK] = places[at[i : i + BLOCK]]
    return numbering.names, at, ends


def train(
    rows: DataFrame,
    marks: DataFrame,
    limit: int = 8_000,
    epochs: int = 4,
    rates: Rates = Rates(2.0, 1.0, 3.0, 0.0),
) -> dict[int, float]:
    """Fit on the texts of ``rows`` (``doc_id, text``) that ``marks`` (``id, label``) labels.

    About ``limit`` ids of each label, chosen by a hash of the id, are learned from one by
    one: the order of updates is what FTRL is about, so one task does it, over a sample of
    bounded size (which also bounds the broadcast that fetches its texts). Both labels
    count as equally likely beforehand. L1 leaves few weights; only those travel, as hash
    and weight.
    """
    found = rows.select("doc_id").join(marks, F.col("doc_id") == F.col("id")).groupBy("label").count()
    counts = {r["label"]: r["count"] for r in found.collect()}
    chosen = None
    for label, count in sorted(counts.items()):
        some = thinned(marks.filter(F.col("label") == label), "id", count, limit)
        chosen = some if chosen is None else chosen.union(some)
    if len(counts) < 2:
        return {}
    sample = rows.join(F.broadcast(stage(chosen, "chosen")), F.col("doc_id") == F.col("id"))

    def fit(group: pa.Table) -> pa.Table:
        order = np.argsort(group["h"].to_numpy(), kind="stable")
        names, at, ends = admitted(Texts(group["text"], order))
        bias = np.int32(np.searchsorted(names, BIAS))
        model = Ftrl(len(names), 1, rates)
        target = group["label"].to_numpy()[order].astype(np.float64)
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(target)):
                grams = np.append(at[ends[i] : ends[i + 1]], bias)
                model.learn(grams, np.ones(len(grams)), target[i : i + 1])
        w = np.concatenate([model.weights(slice(i, i + BLOCK))[:, 0] for i in range(0, len(names), BLOCK)])
        used = np.flatnonzero(w)
        return pa.table({"h": names[used], "w": w[used]})

    dealt = sample.select("text", "label", F.xxhash64("doc_id", F.lit(29)).alias("h"))
    found = dealt.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit, "h long, w double")
    return {r["h"]: r["w"] for r in found.collect()}


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    cut: float = 0.5,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Score every whole text; returns ``doc_id, held_out, score, predicted`` and the columns
    of ``carry``.

    ``labels`` has ``doc_id`` and ``toxic``; rows whose id is in fold 0 or NULL, and NULL
    labels, are never learned from; of several labels of an id the highest counts.
    ``predicted`` is 1 if score >= ``cut``. A text scores by the sum of the weights of its
    distinct grams, so NULL and empty texts get the score of the bias alone. Without labels of
    both kinds nothing tells them apart, and every score is 0. Rows that repeat an id are scored each. The weights' table is
    bounded by the training sample and L1.
    """
    marks = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")).filter("label is not null")
    marks = marks.filter(fold("id", folds) != 0).groupBy("id").agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    weights = train(rows, marks)
    shared = df.sparkSession.sparkContext.broadcast(SparseWeights(weights) if weights else None)

    held = F.coalesce(fold(doc_id, folds) == 0, F.lit(False))
    # Internal names, so that no carried column can clash.
    inputs = df.select(
        F.col(text).alias("_text"),
        F.col(doc_id).alias("_id"),
        held.alias("_held"),
        *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in byte_slices(batches, "_text"):
            score = [0.0 if model is None else model.score(t) for t in texts_of(batch, "_text")]
            names = [*batch.schema.names[1:], "_score"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score, pa.float64())], names)

    scored = inputs.mapInArrow(run, inputs.drop("_text").schema.add("_score", "double"))
    return scored.select(
        F.col("_id").alias("doc_id"),
        F.col("_held").alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= cut).cast("int").alias("predicted"),
        *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry) if c != "doc_id"),
    )
