"""Mixing sources to target weights by subset-sum budget fitting (op 2)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.operators.staging import stage

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# Largest remainder, in words, that the dynamic programme works on: one bit per word.
KNAPSACK_WORDS = 1 << 16
# Documents of one source and length that are ranked together.
RANKED_ROWS = 512


def targets_of(
    totals: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> list[tuple[str | None, int, float]]:
    """``(source, size, target)`` in code-point order, NULL last.

    All sizes together are shared by weight; a share above ``most`` times its source's size
    stops there, and the excess is shared anew among the others until none is above.
    """
    order = sorted((t for t in totals if t[0] is not None), key=lambda t: t[0].encode("utf-8", "surrogatepass"))
    order += [t for t in totals if t[0] is None]
    weight = {i: weights[i % len(weights)] for i in range(len(order))}
    whole, fixed = sum(size for _, size in order), {}
    while len(fixed) < len(order):
        free = [i for i in weight if i not in fixed]
        rest, parts = whole - sum(fixed.values()), sum(weight[i] for i in free)
        over = {i: most * order[i][1] for i in free if rest * weight[i] > most * order[i][1] * parts}
        if not over:
            return [
                (s, n, float(fixed[i]) if i in fixed else rest * weight[i] / parts) for i, (s, n) in enumerate(order)
            ]
        fixed |= over
    return [(s, n, float(fixed[i])) for i, (s, n) in enumerate(order)]


def fit_budget(lengths: list[int], counts: list[int], budget: int, most: int = MOST_REPEATS) -> list[int]:
    """How often to take documents of each length, 0 to ``most`` times their count, so that
    their words come nearest to ``budget`` from below.

    Every length first gives its proportional share, rounded down. Longest first, takings
    then shrink the remainder to knapsack size, or are given back one by one until it is
    that large or nothing is taken. A bounded-knapsack dynamic programme over what may still
    be taken (one bit per reachable sum, counts split into powers of two) fills it: exactly
    where any choice does, for budgets of knapsack size, and nearly always for larger ones.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if not total:
        return [0] * len(lengths)
    budget = min(budget, most * total)
    taken = [c * budget // total for c in counts]
    rest = budget - sum(n * k for n, k in zip(lengths, taken))
    order = sorted(range(len(lengths)), key=lambda i: lengths[i])
    for i in reversed(order):
        if rest <= KNAPSACK_WORDS:
            break
        more = min(most * counts[i] - taken[i], rest // lengths[i], -(-(rest - KNAPSACK_WORDS) // lengths[i]))
        taken[i] += more
        rest -= more * lengths[i]
    while rest < KNAPSACK_WORDS and any(taken):
        for i in order:
            if taken[i] and rest < KNAPSACK_WORDS:
                taken[i] -= 1
                rest += lengths[i]
    reach, steps, mask = 1, [], (1 << (rest + 1)) - 1
    for i in order:
        left, power = min(most * counts[i] - taken[i], rest // lengths[i]), 1
        while left > 0 and not reach >> rest & 1:
            many = min(power, left)
            steps.append((i, many, reach))
            reach |= reach << (many * lengths[i]) & mask
            left, power = left - many, power * 2
    at = reach.bit_length() - 1
    for i, many, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += many
            at -= many * lengths[i]
    return taken


def mix_sources(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 11,
) -> DataFrame:
    """Choose how often each document enters a mix of given source weights.

    Returns one row per input row: ``doc_id, version`` (hash of the text), ``source, size``
    (words), ``source_size, target`` (of its source), ``copies`` (0 to 3) and ``taken``
    (``size * copies``). Every target is fitted by :func:`fit_budget` to the counts of
    documents by exact length. What a length is to give is dealt evenly to its documents;
    those that give one copy more are chosen in the order of a seeded hash of their id and text, so
    reruns agree.

    Only one row per source (totals) reaches the driver; lengths are fitted in one task per
    source, over one row per distinct length. Documents of one length and source are ranked
    in buckets of about 512, so a hot length is spread. NULL and empty texts have size 0 and
    are never taken; NULL is a source of its own, and NULL ids take part. Rows that repeat
    an id are taken each on its own. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = stage(
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(text).alias("version"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    totals = [(r["source"], r["size"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    plan = []
    for rank, (name, size, target) in enumerate(targets_of(totals, weights)):
        plan.append((rank, name, size, float(target), round(target)))
    sources = spark.createDataFrame(plan, "rank int, source string, source_size long, target double, budget long")
    known = rows.join(
        F.broadcast(sources.withColumnRenamed("source", "name")), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name")
    counts = known.filter("size > 0").groupBy("rank", "budget", "size").agg(F.count(F.lit(1)).alias("n"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        lengths, n = group["size"].tolist(), group["n"].tolist()
        taken = fit_budget(lengths, n, int(group["budget"].iloc[0]))
        group["whole"] = [k // c for k, c in zip(taken, n)]
        group["picked"] = [k % c for k, c in zip(taken, n)]
        return group[["rank", "size", "n", "whole", "picked"]]

    form = "rank int, size long, n long, whole int, picked long"
    fitted = stage(counts.groupBy("rank").applyInPandas(fit, form), "fitted")
    # By id and text: rows without an id, or under one repeated id, spread over the buckets of their length too.
    order = F.xxhash64("doc_id", "version", F.lit(seed))
    unit = order.cast("double") / float(2**64) + 0.5
    buckets = F.ceil(F.col("n") / RANKED_ROWS)
    placed = stage(
        known.filter("size > 0")
        .join(fitted, ["rank", "size"])
        .withColumn("bucket", F.when(F.col("picked") > 0, F.floor(unit * buckets))),
        "placed",
    )
    # Whole buckets, in order, then part of one: only the rows of buckets are ranked.
    ahead = Window.partitionBy("rank", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucketed = placed.filter(F.col("bucket").isNotNull())
    quota = (
        bucketed.groupBy("rank", "size", "picked", "bucket")
        .agg(F.count(F.lit(1)).alias("held"))
        .withColumn("quota", F.col("picked") - F.coalesce(F.sum("held").over(ahead), F.lit(0)))
        .select("rank", "size", "bucket", "quota")
    )
    place = Window.partitionBy("rank", "size", "bucket").orderBy(order, "doc_id", "version")
    ranked = (
        bucketed.join(quota, ["rank", "size", "bucket"])
        .withColumn("extra", (F.row_number().over(place) <= F.col("quota")).cast("int"))
    )
    sure = placed.filter(F.col("bucket").isNull()).withColumn("extra", F.lit(0))
    empty = known.filter("size = 0").withColumn("copies", F.lit(0))
    columns = ["doc_id", "version", "source", "size", "source_size", "target"]
    some = [part.select(*columns, (F.col("whole") + F.col("extra")).alias("copies")) for part in (sure, ranked)]
    return (
        some[0].union(some[1]).union(empty.select(*columns, "copies")).withColumn("taken", F.col("size") * F.col("copies"))
    )
