"""Vector bin packing of token sequences (op 8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_slices, texts_of
from tidemark.llm.tokens import encoder


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at once."""

    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


@dataclass
class Example:
    """The part of a document that is not placed yet."""

    doc: object
    ids: bytes
    start: int
    total: int
    loss_from: int

    @property
    def left(self) -> int:
        return self.total - self.start

    def loss(self, length: int) -> int:
        """Loss-bearing tokens among the next ``length``."""
        return max(0, self.start + length - max(self.start, self.loss_from))

    def fits(self, tokens: int, loss: int) -> int:
        """How many of the next tokens may stand where so much room is left."""
        return max(0, min(self.left, tokens, max(0, self.loss_from - self.start) + loss))


class Packer:
    """Fill sequences from a window of waiting examples.

    The next example of a sequence is the one whose demand vector (tokens, segments,
    loss-bearing tokens, each as a share of its limit) has the largest dot product with
    the vector of what is left. When none fits whole, the best one is cut and its rest
    goes on waiting, so only the last sequence of a task can stay short; that one is
    divided into sequences of power-of-two length, which need no padding.
    """

    def __init__(self, limits: Limits, first_id: int, window: int = 512):
        self.limits, self.next_id, self.window = limits, first_id, window
        self.examples: list[Example] = []
        self.demand = np.zeros((window + 1, 3))
        self.pieces: list[tuple] = []
        self.bytes = 0

    def _vector(self, e: Example) -> tuple[float, float, float]:
        return e.left / self.limits.tokens, 1 / self.limits.segments, e.loss(e.left) / max(1, self.limits.loss_tokens)

    def add(self, e: Example) -> None:
        while (n := e.fits(self.limits.tokens, self.limits.loss_tokens)) == self.limits.tokens:
            self._emit([(e, n)])
        if e.left:
            self.demand[len(self.examples)] = self._vector(e)
            self.examples.append(e)
        while len(self.examples) > self.window:
            self._emit(self._fill())

    def finish(self) -> None:
        while self.examples:
            chosen = self._fill()
            size = sum(n for _, n in chosen)
            if self.examples or size in (0, self.limits.tokens):
                self._emit(chosen)
            else:
                self._emit_powers(chosen, size)

    def _fill(self) -> list[tuple[Example, int]]:
        """Choose the pieces of one sequence and take them out of the window."""
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss_tokens
        chosen: list[tuple[Example, int]] = []
        tiny = 1e-9
        while self.examples and tokens and segments:
            count = len(self.examples)
            demand = self.demand[:count]
            room = np.array(
                [tokens / self.limits.tokens, segments / self.limits.segments, loss / max(1, self.limits.loss_tokens)]
            )
            value = demand @ room
            fitting = (demand[:, 0] <= room[0] + tiny) & (demand[:, 2] <= room[2] + tiny)
            cut = not fitting.any()
            if cut:
                fits = np.array([e.fits(tokens, loss) for e in self.examples]) if loss < tokens else None
                if fits is not None and not fits.any():
                    break
                at = int(np.argmax(value if fits is None else np.where(fits > 0, value, -1.0)))
            else:
                at = int(np.argmax(np.where(fitting, value, -1.0)))
            e = self.examples[at]
            n = e.fits(tokens, loss)
            piece = Example(e.doc, e.ids, e.start, e.total, e.loss_from)
            chosen.append((piece, n))
            tokens, segments, loss = tokens - n, segments - 1, loss - e.loss(n)
            e.start += n
            if e.left:
                self.demand[at] = self._vector(e)
            else:
                last = self.examples.pop()
                if at < len(self.examples):
                    self.examples[at] = last
                    self.demand[at] = self.demand[len(self.examples)]
        return chosen

    def _emit(self, chosen: list[tuple[Example, int]]) -> None:
        offset = 0
        for e, n in chosen:
            ids = e.ids[4 * e.start : 4 * (e.start + n)]
            self.pieces.append((e.doc, e.start, n, e.total, self.next_id, offset, ids))
            self.bytes += len(ids)
            offset += n
            e.start += n
        self.next_id += 1

    def _emit_powers(self, chosen: list[tuple[Example, int]], size: int) -> None:
        waiting = [[e, n] for e, n in chosen]
        for power in reversed(range(size.bit_length())):
            room, part = (size & (1 << power)), []
            while room:
                e, n = waiting[0]
                taken = min(room, n)
                part.append((Example(e.doc, e.ids, e.start, e.total, e.loss_from), taken))
                e.start, room = e.start + taken, room - taken
                waiting[0][1] -= taken
                if not waiting[0][1]:
                    waiting.pop(0)
            if part:
                self._emit(part)


def pack_sequences(
    df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", loss_from: str | None = None, limits: Limits = Limits()
) -> DataFrame:
    """Place the token ids of every row into sequences under three limits at once.

    ``ids`` is binary (little-endian unsigned 32 bit); ``loss_from`` may name a column with
    the index of the first loss-bearing token (all bear loss without it or where it is
    NULL). Returns one row per piece: ``doc_id, start, length, doc_tokens, sequence_id,
    offset, ids``. Every task packs the rows it reads in one streaming pass with a window of
    examples, so nothing is shuffled and memory is bounded by the window; at most a dozen
    sequences per task are short, each of them a power of two long. A row without ids
    yields no piece. Rows that repeat an id are packed each.
    """
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(ids).alias("body"),
        (F.lit(0) if loss_from is None else F.coalesce(F.col(loss_from), F.lit(0))).cast("long").alias("loss_from"),
    )
    return _packed(rows, limits, lambda batch: batch.column("body").to_pylist())


def _packed(rows: DataFrame, limits: Limits, ids_of: Callable[[pa.RecordBatch], list[bytes]]) -> DataFrame:
    """Pack ``doc_id, body, loss_from`` rows; ``ids_of`` makes ids of a batch's bodies."""
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name in names[1:-1]:
        schema.add(name, "long")
    schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, TaskContext.get().partitionId() << 40)
        id_type = None

        def flush() -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 5, pa.binary()]
            made = [pa.array(list(c), t) for c, t in zip(zip(*packer.pieces), types)]
            packer.pieces, packer.bytes = [], 0
            return pa.RecordBatch.from_arrays(made, names)

        for batch in byte_slices(batches, "body", 1 << 20):
            id_type = batch.schema.field("doc_id").type
            docs, firsts = batch.column("doc_id").to_pylist(), batch.column("loss_from").to_pylist()
            for doc, data, first in zip(docs, ids_of(batch), firsts):
                if data:
                    packer.add(Example(doc, data, 0, len(data) // 4, first))
            if packer.pieces:
                yield flush()
        packer.finish()
        if packer.pieces:
            yield flush()

    return rows.mapInArrow(run, schema)


def pack_documents(
    df: DataFrame, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each and pack them as :func:`pack_sequences` does.

    NULL text counts as empty. The same task encodes and packs: ids need not pass through
    the JVM in between, and one Python worker is enough.
    """
    end = np.array([end_id], "<u4").tobytes()
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("body"), F.lit(0).cast("long").alias("loss_from")
    )
    return _packed(rows, limits, lambda batch: [ids + end for ids in encoder(path).encode(texts_of(batch, "body"))])
