"""Near-duplicate embeddings by spherical k-means cells and blocked cosine products (op 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import thinned
from tidemark.llm.components import connected_components
from tidemark.operators.staging import stage


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    """Unit vectors in double precision."""
    flat = column.flatten() if hasattr(column, "flatten") else column.tolist()
    x = np.array(flat, np.float64).reshape(len(column), -1)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(unit: DataFrame, cells: int, sample: int, rounds: int, rows: int) -> np.ndarray:
    """Centroids of spherical k-means, fitted on about ``sample`` of the ``rows`` vectors.

    Tasks assign their vectors and sum them by cell; the driver sees one sum per cell and
    round (``cells`` times the dimension), never vectors beyond the ``cells`` starting ones.
    """
    chosen = stage(thinned(unit, "node", rows, sample), "kmeans")
    start = chosen.orderBy(F.xxhash64("node", F.lit(23)), "node").limit(cells)
    centres = _matrix(pd.Series([r["v"] for r in start.select("v").collect()]))
    for _ in range(rounds):
        fixed = centres

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(fixed)
            for batch in batches:
                x = _matrix(batch.column("v"))
                np.add.at(total, (x @ fixed.T).argmax(axis=1), x)
            used = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.float64()))], ["cell", "s"]
            )

        parts = chosen.select("v").mapInArrow(sums, "cell int, s array<double>")
        merged = (
            parts.select("cell", F.posexplode("s").alias("i", "x")).groupBy("cell", "i").agg(F.sum("x").alias("x"))
        )
        total = np.zeros_like(centres)
        for r in merged.collect():
            total[r["cell"], r["i"]] = r["x"]
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centres)
    return centres


def near_embeddings(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.9,
    cell_rows: int = 2000,
    most_cells: int = 4096,
    sample: int = 50_000,
    rounds: int = 4,
    block: int = 1024,
    recall: float = 0.99,
) -> DataFrame:
    """Link vectors with cosine >= ``threshold`` and keep one of each linked group.

    Returns one row per input row: ``vec_id, n_links, component_id, kept``. Equal vectors
    become one node, counted. Spherical k-means (fitted on a bounded sample; about one cell
    per ``cell_rows`` vectors, at most ``most_cells``, which bounds the broadcast table of
    centres) gives every vector its nearest cell; of centres closer than the threshold's
    angle one stays, so a dense group is one cell. Vectors are compared within cells: those whose home it is with
    each other, and with those that visit it. A vector visits the earlier ones among its next nearest
    cells, as many as it takes to find the share ``recall`` of pairs exactly at the threshold,
    where they are hardest to find; that number is measured on made neighbours of sampled vectors. Nearer pairs are found more
    surely, and no pair below the threshold is linked. A cell beyond the block size is divided into parts that meet two at a time
    (matrix products in double precision), all of them, so a hot cell loses nothing. What is shipped for a vector
    depends on the number of cells, not of rows, until cells outgrow the block size.
    NULL, zero and empty vectors and those with
    NULL or non-finite components link with nothing, and neither do vectors of different
    dimension; a NULL id has a NULL component and is kept. Rows that repeat an id count as
    one vector when equal, and as several that share links when not. Ties: the least id names a component. Extra columns are ignored. An empty table gives no rows.
    """
    source = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    single = df.schema[embedding].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"  # what is shuffled; exact either way
    limit = float(np.finfo(np.float64).max)
    good = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= limit)) & F.exists("v", lambda x: x != 0.0)
    key = F.md5(F.array_join(F.col("v").cast("array<string>"), ","))
    usable = source.filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).withColumn("k", key)
    nodes = stage(
        usable.groupBy("k", "vec_id")
        .agg(F.first("v").alias("v"))
        .groupBy("k")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
        .withColumn("d", F.size("v")),
        "nodes",
    )
    found = None
    for row in nodes.groupBy("d").count().collect():  # one row per dimension in use
        unit = nodes.filter(F.col("d") == row["d"]).select("node", "copies", F.col("v").cast(kind).alias("v"))
        cells = int(min(most_cells, max(1, round(row["count"] / cell_rows))))
        centres = fit_cells(unit, cells, sample, rounds, row["count"])
        part = _linked(unit, _apart(centres, angle_of(threshold)), threshold, block, recall, row["count"])
        found = part if found is None else found.union(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "node long, links long, root long")
    found = stage(found, "found")
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("k", "node", "copies").join(links, "node", "left").join(components, "node", "left")
    named = named.select(
        "k",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "node").alias("component"),
    )
    whole = source.select("vec_id", F.when(F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull(), key).alias("k"))
    component = F.coalesce("component", "vec_id")
    return whole.join(named, "k", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _apart(centres: np.ndarray, angle: float) -> np.ndarray:
    """Centres without those nearer than ``angle`` to one that stays: a dense group has one cell."""
    stay = np.ones(len(centres), bool)
    for i in range(len(centres)):
        if stay[i]:
            near = centres[i + 1 :] @ centres[i] > np.cos(angle)
            stay[i + 1 :] &= ~near
    return centres[stay]


def angle_of(cosine: float) -> float:
    return float(np.arccos(np.clip(cosine, -1.0, 1.0)))


def visits_for(x: np.ndarray, centres: np.ndarray, threshold: float, recall: float) -> int:
    """How many of its next nearest cells a vector has to try to find ``recall`` of its links.

    For every vector of ``x`` neighbours are made at exactly the threshold's angle, in random directions. A pair is
    found if the one with the later home has the other's home among its tries.
    """
    rng = np.random.default_rng(29)
    x = np.repeat(x, 8, axis=0)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(away, axis=1, keepdims=True)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * away / np.maximum(size, 1e-300)
    to_x, to_y = x @ centres.T, y @ centres.T
    home_x, home_y = to_x.argmax(axis=1), to_y.argmax(axis=1)
    later, earlier = np.where((home_x > home_y)[:, None], to_x, to_y), np.minimum(home_x, home_y)
    # Cells nearer to the later one than the earlier one's home, itself included.
    rank = (later > later[np.arange(len(x)), earlier][:, None]).sum(axis=1)
    rank[home_x == home_y] = 0
    return int(np.quantile(rank, recall, method="higher"))


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (smallest members) after linking ``a`` with ``b``, pair by pair."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _linked(
    unit: DataFrame, centres: np.ndarray, threshold: float, block: int, recall: float, rows: int
) -> DataFrame:
    """Rows ``node, links, root``: verified links, counted once, and one root per task and node."""
    side = max(block, min(4 * block, (1 << 22) // centres.shape[1]))  # rows of a part: bounds a task's memory
    context, kind = unit.sparkSession.sparkContext, unit.schema["v"].dataType.simpleString()
    # At most about 1000 vectors, to measure with.
    some = thinned(unit, "node", rows, 1000, seed=31).select("v").collect()
    tries = visits_for(_matrix(pd.Series([r["v"] for r in some])), centres, threshold, recall) if some else 0
    fixed = context.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v")) if batch.num_rows else np.zeros((0, fixed.value.shape[1]))
            own, visits = [], []
            for i in range(0, len(x), 4096):
                product = x[i : i + 4096] @ fixed.value.T
                home = product.argmax(axis=1)
                own.append(home)
                # Among the nearest cells, those before the own one: each pair of cells meets once.
                near = np.argpartition(-product, min(tries, product.shape[1] - 1), axis=1)[:, : tries + 1]
                visits += [np.sort(c[c < h]).astype(np.int32) for c, h in zip(near, home)]
            own = np.concatenate(own) if own else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array(visits, pa.list_(pa.int32()))],
                ["node", "copies", "v", "own", "visits"],
            )

    guests = stage(unit.mapInArrow(assign, f"node long, copies long, v {kind}, own int, visits array<int>"), "visits")
    seats = F.concat(
        F.array(F.struct(F.col("own").alias("bucket"), F.lit(True).alias("member"))),
        F.transform("visits", lambda b: F.struct(b.alias("bucket"), F.lit(False).alias("member"))),
    )
    seated = guests.select("node", "copies", "v", F.explode(seats).alias("s")).select("node", "copies", "v", "s.*")
    sizes = stage(
        seated.groupBy("bucket").agg(
            F.ceil(F.count_if("member") / side).cast("int").alias("inner"),
            F.ceil(F.count_if(~F.col("member")) / side).cast("int").alias("outer"),
        ),
        "sizes",
    )
    # Parts of members meet all parts; parts of visitors meet those of members only.
    tasks = (
        seated.join(sizes, "bucket")
        .withColumn("h", F.xxhash64("node", F.lit(5)))
        .withColumn("part", F.when(F.col("member"), F.pmod("h", "inner")).otherwise(F.col("inner") + F.pmod("h", "outer")))
        .withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("inner") + F.when(F.col("member"), F.col("outer")).otherwise(0) - 1))
        )
        .withColumn("p", F.least("part", "other").cast("int"))
        .withColumn("q", F.greatest("part", "other").cast("int"))
        .select("bucket", "p", "q", (F.col("part") == F.col("p")).alias("first"), "node", "copies", "v")
    )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, p, q = key
        group = group.sort_values("node", kind="stable")
        node, copies, x = group["node"].to_numpy(), group["copies"].to_numpy(), _matrix(group["v"])
        count, root = np.zeros(len(node), np.int64), np.arange(len(node))
        one, two = np.flatnonzero(group["first"]), np.flatnonzero(~group["first"])
        if p == q:
            two = one
        right = x[two]
        for i in range(0, len(one), 256):
            rows = one[i : i + 256]
            hits = x[rows] @ right.T >= threshold
            if p == q:  # each pair of a part once
                hits &= rows[:, None] < two[None, :]
            if hits.any():
                count[rows] += hits @ copies[two]
                count[two] += copies[rows] @ hits
                a, b = np.nonzero(hits)
                root = _join(root, rows[a], two[b])
        some = (count > 0) | (root != np.arange(len(node)))
        return pd.DataFrame({"node": node[some], "links": count[some], "root": node[root[some]]})

    return tasks.groupBy("bucket", "p", "q").applyInPandas(compare, "node long, links long, root long")
