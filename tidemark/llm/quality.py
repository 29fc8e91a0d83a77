"""Quality scores: random Fourier features, ridge regression, isotonic calibration (op 1)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_slices, fold, texts_of
from tidemark.operators.staging import stage

STATISTICS = (
    "characters", "words", "word_length", "distinct_words", "same_as_last", "upper_words", "digits", "symbols",
    "exclamations", "stops", "commas", "bars", "lines", "repeated_lines", "words_a_line", "repeated_triples",
    "short_words", "non_ascii",
)
SYMBOLS = "#*$%&<>@~^=_{}[]\\"
BIN = 1000  # ridge scores are calibrated in steps of 1 / BIN
BINS = (-1000, 2000)


def statistics_of(text: str) -> list[float]:
    """Document statistics of a whole text: shares and logarithms, all 0 for an empty one."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lines = [x for x in text.split("\n") if x.strip()]
    size = len(text)
    letters = sum(map(len, words))
    triples = set(zip(words, words[1:], words[2:]))
    return [
        np.log1p(size),
        np.log1p(n),
        np.log(letters / n),
        len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        np.sqrt(sum(map(text.count, "0123456789")) / letters),
        np.sqrt(sum(map(text.count, SYMBOLS)) / letters),
        np.sqrt(text.count("!") / n),
        np.sqrt(text.count(".") / n),
        np.sqrt(text.count(",") / n),
        np.sqrt(text.count("|") / n),
        np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        1 - len(triples) / max(1, n - 2) if n > 2 else 0.0,
        sum(len(w) < 3 for w in words) / n,
        (len(text.encode()) - size) / letters,
    ]


class FourierRidge:
    """Standardised statistics, random Fourier features of a Gaussian kernel, ridge weights."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, width: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = rng.normal(0, 1 / width, (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.spread, -6, 6)
        z = np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta


def pool(bins: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: block centres and their values."""
    blocks: list[list[float]] = []
    for x, g, n in zip(bins, good, total):
        blocks.append([x * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def _x(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("x").to_pylist(), np.float64).reshape(batch.num_rows, len(STATISTICS))


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    cut: float = 0.3,
    features: int = 192,
    width: float = 3.0,
    ridge: float = 1.0,
) -> DataFrame:
    """Score every whole text; returns ``doc_id, held_out, score, predicted``.

    ``labels`` has ``doc_id`` and ``quality``. Fold 0 is never learned from; the last fold
    calibrates and the others fit. The statistics of every document are computed in one
    scan and written; all labelled rows are used. Tasks sum the normal equations of their
    rows, Spark adds the sums up, and only they reach the driver (a square of the number
    of features, whatever the input), as do counts per calibration step. ``predicted`` is 1
    if score >= ``cut``. NULL and empty texts have statistics 0 and a score like any other.
    NULL labels and ids are not learned from, of several labels of an id the highest counts;
    without labels every score is 0.5. Rows that repeat an id are scored each.
    """
    held = F.coalesce(fold(doc_id, folds) == 0, F.lit(False)).alias("held_out")
    rows = df.select(F.col(doc_id).alias("doc_id"), held, F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            made = pa.array([statistics_of(t) for t in texts_of(batch, "text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), made], ["doc_id", "held_out", "x"]
            )

    schema = rows.select("doc_id", "held_out").schema.add("x", T.ArrayType(T.DoubleType()))
    measured = stage(rows.mapInArrow(measure, schema), "statistics")
    marks = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).filter("label is not null")
    marks = marks.filter(fold("id", folds) != 0).groupBy("id").agg(F.max("label").cast("double").alias("label"))
    known = measured.join(marks, F.col("doc_id") == F.col("id")).select(
        "x", "label", (fold("doc_id", folds) == folds - 1).alias("calibrates")
    )
    known = stage(known, "labelled")
    fitted = known.filter("not calibrates")
    parts = [F.count(F.lit(1)).alias("n")]
    for i in range(len(STATISTICS)):
        parts += [F.avg(F.col("x")[i]).alias(f"m{i}"), F.stddev_pop(F.col("x")[i]).alias(f"s{i}")]
    row = fitted.agg(*parts).first()
    model = None
    if row["n"]:
        k = range(len(STATISTICS))
        model = FourierRidge(
            np.array([row[f"m{i}"] for i in k]), np.array([row[f"s{i}"] for i in k]), features, width
        )
        model.beta = _solve(fitted, model, ridge)
        model.steps = _calibrate(known, model)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = np.interp(model.raw(_x(batch)), *model.steps)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"]
            )

    schema = rows.select("doc_id", "held_out").schema.add("score", "double")
    return measured.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def _solve(rows: DataFrame, model: FourierRidge, ridge: float) -> np.ndarray:
    """Ridge weights from normal equations that every task sums over its rows."""
    size = len(model.b) + 1
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = shared.value.features(_x(batch))
            total += z.T @ np.column_stack([z, batch.column("label").to_numpy(zero_copy_only=False)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "s"]
        )

    # A tree of two levels: each task sums several partitions, as many as there are tasks; their sums are added
    # after a shuffle. The labelled statistics are small, a sum is not.
    tasks = max(16, math.isqrt(rows.rdd.getNumPartitions()))
    parts = rows.select("x", "label").coalesce(tasks).mapInArrow(sums, "i int, s array<double>")
    cells = parts.select("i", F.posexplode("s").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s"))
    whole = np.zeros((size, size + 1))
    for r in cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "s"))).alias("row")).collect():
        whole[r["i"]] = [c["s"] for c in r["row"]]
    penalty = ridge * np.eye(size)
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(whole[:, :-1] + penalty, whole[:, -1])


def _calibrate(known: DataFrame, model: FourierRidge) -> tuple[np.ndarray, np.ndarray]:
    """Steps from ridge scores to probabilities, on the calibration fold (on all rows without one)."""
    shared = known.sparkSession.sparkContext.broadcast(model)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.clip(np.floor(shared.value.raw(_x(batch)) * BIN), *BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b), batch.column("label"), batch.column("calibrates")], ["b", "label", "calibrates"]
            )

    scored = known.mapInArrow(bins, "b int, label double, calibrates boolean")
    counts = scored.groupBy("b").agg(
        F.sum(F.when(F.col("calibrates"), F.col("label"))).alias("good"),
        F.count(F.when(F.col("calibrates"), 1)).alias("n"),
        F.sum("label").alias("all_good"),
        F.count(F.lit(1)).alias("all"),
    )
    rows = sorted(counts.collect(), key=lambda r: r["b"])
    some = [(r["b"], r["good"], r["n"]) for r in rows if r["n"]] or [(r["b"], r["all_good"], r["all"]) for r in rows]
    b, good, n = (np.array(c, np.float64) for c in zip(*some))
    return pool((b + 0.5) / BIN, good, n)
