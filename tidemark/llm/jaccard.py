"""Similarity join on sets of word n-grams by banded MinHash (op 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, byte_slices, mix64, texts_of, words_of
from tidemark.llm.components import connected_components
from tidemark.operators.staging import stage

# Grams that the texts of one comparing task hold at most on average: bounds its memory.
GRAMS_IN_TASK = 4_000_000


def choose_bands(threshold: float, recall: float, most_rows: int = 8) -> tuple[int, int]:
    """Bands and rows per band: the most selective banding that 128 values allow.

    A pair with similarity s shares one of b bands of r rows with probability
    1 - (1 - s^r)^b. For each r the smallest b that reaches ``recall`` at ``threshold``
    is known; the largest r whose b * r stays within 128 makes the fewest chance meetings.
    """
    best = (1, 1)
    for r in range(1, most_rows + 1):
        missed = 1 - threshold**r
        b = 1 if missed <= 0 else int(np.ceil(np.log(1 - recall) / np.log(missed)))
        if b * r <= 128:
            best = (max(1, b), r)
    return best


def ngram_hashes(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text.

    A text of fewer than ``n`` words, but at least one, has a single gram of all its words.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    n = min(n, len(h))
    with np.errstate(over="ignore"):
        grams = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            grams = grams * np.uint64(0x100000001B3) + h[i : len(h) - n + 1 + i]
    return np.unique(mix64(grams))


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int = 7) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature of a set of gram hashes."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(grams), 2048):  # keeps the table of products in the cache
            low = np.minimum(low, ((grams[None, i : i + 2048] ^ b[:, None]) * a[:, None]).min(axis=1))
        signature = mix64(low).reshape(bands, rows)
        out = np.full(bands, rows, np.uint64)
        for r in range(rows):
            out = mix64(out * np.uint64(0x100000001B3) + signature[:, r])
    return out.view(np.int64)


def link_group(grams: list[np.ndarray], threshold: float, skip: np.ndarray, column_block: int = 4096):
    """Verified pairs of one group: boolean matrix of links that no earlier band has seen,
    and the full one. Intersections are counted exactly, block by block of grams."""
    m = len(grams)
    sizes = np.array([len(g) for g in grams], np.float64)
    values, at = np.unique(np.concatenate(grams), return_inverse=True)
    rows = np.repeat(np.arange(m), sizes.astype(int))
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    # Grams that only one member has count for no pair.
    shared = np.bincount(at, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    at, rows = number[at[keep]], rows[keep]
    common = np.zeros((m, m))
    for start in range(0, int(shared.sum()), column_block):
        i, j = np.searchsorted(at, [start, start + column_block])
        table = np.zeros((m, column_block), np.float32)
        table[rows[i:j], at[i:j] - start] = 1
        common += table @ table.T
    linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(linked, False)
    return linked & ~skip, linked


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Smallest member that each member reaches inside a group."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(root)).min(axis=1)
        low = np.minimum(root, low)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def similar_texts(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999,
    block: int = 256,
    versions: bool = False,
) -> DataFrame:
    """Group documents whose word n-gram sets have a Jaccard similarity of ``threshold`` or more.

    Returns one row per input row: ``doc_id, n_links`` (other documents linked directly,
    exact copies included), ``component_id`` (smallest id reachable by links) and ``kept``
    (the document is that one).

    1. Every whole text is hashed into bands once; equal texts become one node, counted.
    2. Band hashes are shuffled. Only those that several nodes share go on, and of
       several bands with the very same members one.
    3. The members' texts are fetched, and each group is compared on full n-gram sets. A
       group of more than ``block`` members is divided, and every two parts meet in a task
       of their own, so no task holds a large group. Only counts and one link to a root
       per member leave a task, never all pairs; a pair that meets in several bands is
       counted in the first.
    4. The roots are joined to components.

    The number of true links within one large group of *different* texts is quadratic by
    nature; the compared blocks are matrix products. Documents without words, NULL texts
    and NULL ids link with nothing; a NULL id has a NULL component and is kept. Rows that
    repeat an id with the same text are one document; with different texts, they are
    compared under the one id. ``versions`` appends ``k``, the MD5 of the text (NULL for a
    NULL id). An empty table gives no rows.
    """
    bands, rows = choose_bands(threshold, recall)
    source = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.md5(F.col(text)).alias("k")
    )
    usable = source.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(WORD))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            sets = [ngram_hashes(t, n) for t in texts_of(batch, "text")]
            made = np.array([band_hashes(s, bands, rows) for s in sets], np.int64).reshape(len(sets), bands)
            offsets = pa.array(np.arange(0, made.size + 1, bands), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("k"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(made.ravel())),
                ],
                ["doc_id", "k", "grams", "bands"],
            )

    signed = stage(
        usable.mapInArrow(sign, "doc_id long, k string, grams long, bands array<long>")
        .groupBy("k", "doc_id")
        .agg(F.first("grams").alias("grams"), F.first("bands").alias("bands"))
        .groupBy("k")
        .agg(
            F.min("doc_id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("grams").alias("grams"),
            F.first("bands").alias("bands"),
        ),
        "signed",
    )
    met = signed.select("node", "grams", F.posexplode("bands").alias("band", "value"))
    groups = (
        met.groupBy("band", "value")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("grams").alias("grams"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.sum(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(2**31 - 1))).alias("y"),
        )
        .filter("members > 1")
        .groupBy("members", "grams", "x", "y")
        .agg(F.min(F.struct("band", "value")).alias("g"))
        .select(
            "g.band",
            "g.value",
            F.ceil(F.greatest(F.col("members") / block, F.col("grams") / GRAMS_IN_TASK)).cast("int").alias("parts"),
        )
    )
    members = stage(met.drop("grams").join(stage(groups, "groups"), ["band", "value"]), "members")
    # A part meets itself and every other part: the unordered pair of parts names the task.
    tasks = (
        members.withColumn("part", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("p", F.least("part", "other"))
        .withColumn("q", F.greatest("part", "other"))
    )
    wanted = signed.join(members.select("node").distinct(), "node", "left_semi").select("node", "k", "copies", "bands")
    bodies = stage(
        usable.withColumnRenamed("doc_id", "node").join(wanted, ["node", "k"]).dropDuplicates(["node", "k"]), "bodies"
    )
    placed = tasks.join(bodies, "node").select("band", "value", "p", "q", "part", "node", "copies", "bands", "text")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        band, _, p, q = key
        group = group.sort_values("node", kind="stable").drop_duplicates(["node", "text"])
        node = group["node"].to_numpy()
        hashes = np.array(group["bands"].tolist(), np.int64).reshape(len(node), -1)
        skip = node[:, None] == node[None, :]
        for h in hashes.T[:band]:
            skip |= h[:, None] == h[None, :]
        if p != q:  # pairs inside a part are counted where the part meets itself
            side = group["part"].to_numpy()
            skip |= side[:, None] == side[None, :]
        fresh, linked = link_group([ngram_hashes(t, n) for t in group["text"]], threshold, skip)
        count = fresh.astype(np.int64) @ group["copies"].to_numpy()
        root = node[roots_of(linked)]
        some = (count > 0) | (root != node)
        return pd.DataFrame({"node": node[some], "links": count[some], "root": root[some]})

    found = stage(
        placed.groupBy("band", "value", "p", "q").applyInPandas(compare, "node long, links long, root long"), "found"
    )
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (
        signed.select("k", "node", "copies")
        .join(links, "node", "left")
        .join(parts, "node", "left")
        .select(
            "k",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    keyed = source.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("k")).alias("k"))
    component = F.coalesce("component", "doc_id")
    return keyed.join(nodes, "k", "left").select(
        "doc_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        *(["k"] if versions else []),
    )
