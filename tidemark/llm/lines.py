"""Removal of lines that many documents share, by a sharded minimal perfect hash (op 12)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, mix64
from tidemark.operators.staging import stage

WHITE = " \t\n\x0b\x0c\r"
SHARD_KEYS = 100_000
PART_PROBES = 400_000
# Bits of a level of the hash per key that reaches it.
ROOM = 2


def _keys_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Line offsets of every text, the lines, and their keys (stripped, A-Z in lower case)."""
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    return lines.offsets.to_numpy(), flat, pc.ascii_lower(pc.ascii_trim(flat, characters=WHITE))


def _digests(keys: pa.Array, least_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the keys that are long enough, and their 128-bit hashes as rows of two words."""
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), least_chars).to_numpy(zero_copy_only=False))
    raw = b"".join(xxhash.xxh3_128_digest(k.as_buffer()) for k in keys.take(pa.array(at)))
    return at, np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)


def _slots(h: np.ndarray, print_: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of every 128-bit key on a level of ``size`` bits; all 128 bits count on every level."""
    odd = np.uint64(2 * level + 1)
    with np.errstate(over="ignore"):
        return mix64(h * odd + mix64(print_ + odd)) % np.uint64(size)


class PerfectHash:
    """Minimal perfect hash in levels of bits.

    Every level has :data:`ROOM` bits for each key that reaches it. A key that is alone on
    its bit sets the bit; the others go on to the next level. The number of a key is the number of
    set bits before its own, so ``n`` keys are numbered 0 to ``n - 1`` without being stored.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [np.cumsum(bits) for bits in levels]

    @classmethod
    def build(cls, h: np.ndarray, print_: np.ndarray) -> PerfectHash:
        """From distinct pairs of words."""
        levels: list[np.ndarray] = []
        while len(h):
            size = ROOM * len(h)
            slots = _slots(h, print_, len(levels), size)
            alone = np.bincount(slots.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            left = ~alone[slots]
            h, print_ = h[left], print_[left]
        return cls(levels)

    def number(self, h: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """Numbers of the keys; of a key that was not built in, -1 or the number of any other."""
        found = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for level, bits in enumerate(self.levels):
            slots = _slots(h[left], print_[left], level, len(bits))
            hit = bits[slots]
            found[left[hit]] = self.before[level] + self.ranks[level][slots[hit]] - 1
            left = left[~hit]
            if not len(left):
                break
        return found

    def to_bytes(self) -> tuple[list[int], bytes]:
        return [len(bits) for bits in self.levels], b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, sizes: Sequence[int], packed: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(packed, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def document_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 40) -> DataFrame:
    """Rows ``doc_id, version, hs, prints``: the distinct long lines of every row, as two arrays of hashes.

    ``version`` is a hash of the text. Rows without a long line are left out.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            offsets, _, keys = _keys_of(pc.fill_null(batch.column("text"), ""))
            at, words = _digests(keys, least_chars)
            row = np.searchsorted(offsets, at, side="right") - 1
            order = np.lexsort((words[:, 1], words[:, 0], row))
            row, words = row[order], words[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (words[1:] != words[:-1]).any(axis=1)
            row, words = row[new], words[new]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(words[:, i]).view(np.int64)))
                for i in (0, 1)
            ]
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), *lists], OUT_NAMES)
            yield out.filter(pa.array(ends[1:] > ends[:-1]))

    rows = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    kind = df.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(hashed, f"doc_id {kind}, version long, hs array<long>, prints array<long>")


OUT_NAMES = ["doc_id", "version", "hs", "prints"]


def _each(lines: DataFrame, *more: str) -> DataFrame:
    pairs = lines.select(*more, F.explode(F.arrays_zip("hs", "prints")).alias("k"))
    return pairs.select(*more, F.col("k.hs").alias("h"), F.col("k.prints").alias("print"))


def _shard(h: Column, shards: int) -> Column:
    return F.pmod(h, F.lit(shards))


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """One row per shard: a perfect hash of its distinct lines, and three arrays in the order of its numbers.

    ``prints`` has 64 bits of every line that the hash did not keep, ``counts`` the number of documents (255: or more),
    ``last`` the largest document id. ``probes`` is the number of document lines of the shard.
    """

    def built(batch: pa.Table) -> pa.Table:
        h, print_ = (batch.column(c).to_numpy().view(np.uint64) for c in ("h", "print"))
        hash_ = PerfectHash.build(h, print_)
        order = np.argsort(hash_.number(h, print_))
        sizes, packed = hash_.to_bytes()
        n = batch.column("n").to_numpy()
        last = batch.column("last").combine_chunks().take(pa.array(order))
        row = {
            "shard": batch.column("shard")[:1],
            "probes": pa.array([int(n.sum())]),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "bits": pa.array([packed], pa.binary()),
            "prints": pa.array([print_[order].tobytes()], pa.binary()),
            "counts": pa.array([np.minimum(n, 255).astype(np.uint8)[order].tobytes()], pa.binary()),
            "last": pa.ListArray.from_arrays([0, len(last)], last),
        }
        return pa.table(row)

    kind = lines.schema["doc_id"].dataType.simpleString()
    # Each row holds a line once, so rows count documents; hot lines are combined before the shuffle.
    counted = _each(lines, "doc_id").groupBy("h", "print").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    return (
        counted.withColumn("shard", _shard(F.col("h"), shards))
        .groupBy("shard")
        .applyInArrow(
            built,
            "shard long, probes long, sizes array<long>, bits binary, prints binary, counts binary, "
            f"last array<{kind}>",
        )
    )


def probe_index(lines: DataFrame, index: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """Rows ``doc_id, version, hs, prints``: the lines that each document loses, by looking into the arrays.

    A document sends a shard one row with its lines there. A shard that gets more than
    :data:`PART_PROBES` lines, as the one of a line that half of all documents share does, is dealt out in parts,
    each with a copy of its arrays.
    """

    def probed(batches: pa.Table) -> pa.Table:
        arrays = batches.filter(pc.is_valid(batches.column("bits")))
        asked = batches.filter(pc.is_null(batches.column("bits")))
        if not arrays.num_rows:
            return asked.select(OUT_NAMES).slice(0, 0)
        of = arrays.slice(0, 1).to_pylist()[0]
        hash_ = PerfectHash.from_bytes(of["sizes"], of["bits"])
        kept_prints, counts = np.frombuffer(of["known"], np.uint64), np.frombuffer(of["counts"], np.uint8)
        last = arrays.column("last").combine_chunks().flatten()
        out = []
        for batch in asked.to_batches():
            hs, prints = (batch.column(c).flatten().to_numpy().view(np.uint64) for c in ("hs", "prints"))
            sizes = pc.list_value_length(batch.column("hs")).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            number = hash_.number(hs, prints)
            known = (number >= 0) & (kept_prints[number] == prints)
            often = known & (counts[number] >= least_docs)
            own = batch.column("doc_id").take(pa.array(row))
            latest = last.take(pa.array(np.where(number < 0, 0, number)))
            stays = pc.fill_null(pc.equal(own, latest), False).to_numpy(zero_copy_only=False)
            # NULL is the least id: lines that only rows without an id hold stay.
            stays |= pc.and_(pc.is_null(own), pc.is_null(latest)).to_numpy(zero_copy_only=False)
            gone = often & ~stays
            ends = np.searchsorted(row[gone], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[gone].view(np.int64))) for x in (hs, prints)]
            found = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), *lists], OUT_NAMES)
            out.append(found.filter(pa.array(ends[1:] > ends[:-1])))
        return pa.Table.from_batches(out) if out else asked.select(OUT_NAMES).slice(0, 0)

    kind = lines.schema["doc_id"].dataType.simpleString()
    parts = F.ceil(F.col("probes") / PART_PROBES)
    hot = index.filter(parts > 1).select("shard", parts.alias("parts"))
    asked = (
        _each(lines, "doc_id", "version")
        .groupBy("doc_id", "version", _shard(F.col("h"), shards).alias("shard"))
        # A set: rows that repeat an id and a text ask once.
        .agg(F.collect_set(F.struct("h", "print")).alias("each"))
        .join(hot, "shard", "left")
        .select(
            "shard",
            F.pmod(F.xxhash64("doc_id", "version"), F.coalesce("parts", F.lit(1))).alias("part"),
            "doc_id",
            "version",
            F.col("each.h").alias("hs"),
            F.col("each.print").alias("prints"),
        )
    )
    dealt = index.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "shard", "part", "sizes", "bits", F.col("prints").alias("known"), "counts", "last"
    )
    both = asked.unionByName(dealt, allowMissingColumns=True)
    return both.groupBy("shard", "part").applyInArrow(
        probed, f"doc_id {kind}, version long, hs array<long>, prints array<long>"
    )


def drop_common_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = 40,
    least_docs: int = 5,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Remove lines that many documents hold from all but the one with the largest id.

    Texts are split at newlines. A line's key is the line without the white space around it, A-Z in lower
    case. Keys of at least ``least_chars`` code points that occur in at least ``least_docs`` (255 at most) documents
    lose all their lines, except in the document of the largest id that holds them.
    Returns ``doc_id, text, n_lines, n_dropped, kept_sha256`` and the columns of ``carry``, one row per input row:
    the lines left, joined by newlines, the number of lines before, of lines removed, and the hash of the new text.

    NULL text counts as one empty line and stays NULL. Every row is a document: rows that
    repeat an id count apiece, and keep their lines if the id is the largest. NULL is less than any id; lines held only by rows without
    an id stay. No length is cut; extra columns are ignored unless carried. An empty table gives no rows.
    """
    lines = stage(document_lines(df, doc_id, text, least_chars), "lines")
    total = lines.agg(F.sum(F.size("hs")).alias("n")).first()["n"] or 0
    shards = max(8, -(-total // SHARD_KEYS))
    index = stage(build_index(lines, shards), "index")
    answers = probe_index(lines, index, shards, least_docs)
    # Rows with equal id and text ask the same and get the same answer, once for all of them.
    gone = answers.groupBy("doc_id", "version").agg(F.collect_set(F.struct("hs", "prints")).alias("each"))
    gone = stage(
        gone.select(
            F.col("doc_id").alias("hit_id"),
            F.col("version").alias("hit_version"),
            F.flatten("each.hs").alias("hs"),
            F.flatten("each.prints").alias("prints"),
        ),
        "dropped",
    )
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("version"),
        F.struct(F.lit(0).alias("_"), *carry).alias("carried"),
    )
    joined = rows.join(
        gone, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version")), "left"
    ).drop("hit_id", "hit_version", "version")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            texts = batch.column("text")
            filled = pc.fill_null(texts, "")
            offsets, flat, keys = _keys_of(filled)
            at, words = _digests(keys, least_chars)
            owner = np.searchsorted(offsets, at, side="right") - 1
            stay = np.ones(len(flat), bool)
            for i in np.flatnonzero(pc.is_valid(batch.column("hs")).to_numpy(zero_copy_only=False)):
                here = slice(*np.searchsorted(owner, [i, i + 1]))
                lost = {*zip(batch.column("hs")[i].as_py(), batch.column("prints")[i].as_py())}
                own = words[here].view(np.int64)
                stay[at[here]] = [pair not in lost for pair in zip(own[:, 0].tolist(), own[:, 1].tolist())]
            left = np.concatenate([[0], np.cumsum(stay)])[offsets].astype(np.int32)
            rest = pc.binary_join(pa.ListArray.from_arrays(left, flat.filter(pa.array(stay))), "\n")
            n_lines = np.diff(offsets)
            out = {
                "doc_id": batch.column("doc_id"),
                "text": pc.if_else(pc.is_valid(texts), rest, pa.scalar(None, rest.type)),
                "n_lines": pa.array(n_lines.astype(np.int64)),
                "n_dropped": pa.array((n_lines - np.diff(left)).astype(np.int64)),
                "kept_sha256": pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in rest]),
                "carried": batch.column("carried"),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    cut_rows = joined.mapInArrow(
        cut,
        f"doc_id {kinds['doc_id']}, text string, n_lines long, n_dropped long, kept_sha256 string, "
        f"carried {kinds['carried']}",
    )
    return cut_rows.select(
        "doc_id", "text", "n_lines", "n_dropped", "kept_sha256", *(F.col("carried")[c].alias(c) for c in carry)
    )
