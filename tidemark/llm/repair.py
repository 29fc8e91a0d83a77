"""Repair of the turn structure of conversations by branch and bound (op 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# Who spoke last in the repaired conversation.
START, SYSTEM, USER, ASSISTANT = range(4)
# The speaker that has to follow.
NEXT = (USER, USER, ASSISTANT, USER)
FINISHED = (START, ASSISTANT)
NAMES = ("", "system", "user", "assistant")
DELETE, INSERT, RENAME, TRUNCATED = 4, 3, 3, 3

# A row in one byte: who speaks, by the role's initial (0: none that may stay), and two flags.
SPEAKERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
HAS_TO_GO, CUT = 4, 8


def _moves(fact: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that take a row, as (initial, next state, cost), in the order of their initials."""
    found = [("D", state, DELETE)]
    if not fact & HAS_TO_GO:
        speaker, extra = fact & 3, TRUNCATED if fact & CUT else 0
        if speaker and (speaker == NEXT[state] or (speaker, state) == (SYSTEM, START)):
            found.append(("K", speaker, extra))
        found.append(("R", NEXT[state], RENAME + extra))
    return found


def suffix_bounds(facts: bytes) -> tuple[list[int], int]:
    """What the rows from each one on cost at least, whatever stands before them, and the cost of the whole.

    One backward pass over the cheapest completion of each state; the bound of a row is the cheapest of its states.
    """

    def with_inserts(costs: list[int]) -> list[int]:
        for _ in NEXT:
            costs = [min(costs[s], INSERT + costs[NEXT[s]]) for s in range(4)]
        return costs

    never = DELETE * len(facts) + 4 * INSERT
    costs = with_inserts([0 if s in FINISHED else never for s in range(4)])
    bounds = [min(costs)]
    for fact in reversed(facts):
        costs = with_inserts([min(cost + costs[then] for _, then, cost in _moves(fact, s)) for s in range(4)])
        bounds.append(min(costs))
    return bounds[::-1], costs[START]


def cheapest_edits(facts: bytes) -> tuple[int, str]:
    """The cheapest edits of a conversation, as (cost, initials); of several, the least in ASCII.

    Depth first with an explicit stack. Branches come in the order of their initials, so prefixes are met in
    the order of their audits: a prefix that reaches a node (row, last speaker) at no lower cost than an
    earlier one is worse, and the table of the node drops it. A prefix whose cost and suffix bound
    exceed the incumbent is cut; the incumbent starts with the cost from the backward pass, and no audit. When
    the stack is empty, nothing cheaper and nothing as cheap with a lesser audit is left. Bounds
    are off by the price of one change of speaker at most, so a node is entered a few times at most.
    """
    bounds, best = suffix_bounds(facts)
    audit: str | None = None
    reached: dict[tuple[int, int], int] = {}
    path: list[str] = []
    stack: list[tuple[int, int, int, int, str]] = [(0, START, 0, 0, "")]
    while stack:
        row, state, cost, depth, edit = stack.pop()
        path[depth:] = edit
        bound = cost + bounds[row]
        if bound > best or (audit is not None and bound == best) or reached.get((row, state), best + 1) <= cost:
            continue
        reached[row, state] = cost
        if row == len(facts) and state in FINISHED:
            best, audit = cost, "".join(path)
            continue
        branches = [(row, NEXT[state], cost + INSERT, len(path), "I")]
        if row < len(facts):
            branches += [(row + 1, s, cost + c, len(path), e) for e, s, c in _moves(facts[row], state)]
        # The least initial comes off the stack first.
        stack += sorted(branches, key=lambda b: b[4], reverse=True)
    assert audit is not None
    return best, audit


def damage_rows(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows ``conv_id, turn, role, text, copies`` of conversations, damaged by a hash of id and turn.

    Of 20 remainders of crc32(``conv_id:turn``), 0 drops the row (no copies), 1 empties the text, 2 removes
    its end marks, 3 repeats the row (two copies), 4 makes the role ``user``. NULL counts as one space,
    but stays NULL in ``conv_id`` and ``turn``.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)))
    h = F.crc32(name) % 20
    words = F.coalesce(F.col(text), F.lit(" "))
    return df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(h == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(words, "[.!?]", "")).otherwise(words).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"),
    )


def _values(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
    for batch in byte_slices(batches, "text"):
        yield from zip(*(c.to_pylist() for c in batch.columns))


class Report:
    """What the rows of one conversation show, taken in their order; a byte and a digest per row."""

    def __init__(self) -> None:
        self.facts = bytearray()
        self.seen: set[bytes] = set()
        self.turns: list[int] = []
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.distinct += not self.turns or turn != self.turns[-1]
            self.turns = [self.turns[0] if self.turns else turn, turn]
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        fact = SPEAKERS.get(role[:1], 0)
        digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
        words = text.rstrip(WHITE)
        if not words:
            self.blank += 1
            fact |= HAS_TO_GO
        elif digest in self.seen:
            self.duplicate += 1
            fact |= HAS_TO_GO
        elif words[-1] not in ENDS:
            self.truncated += 1
            fact |= CUT
        self.seen.add(digest)
        self.facts.append(fact)

    def row(self) -> tuple[Any, ...]:
        gaps = self.turns[-1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *cheapest_edits(bytes(self.facts))


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
ORDER = ["role", "text"]


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (as :func:`damage_rows` gives them): counts of faults, ``cost`` and ``audit``.

    Rows of a conversation come in the order of turn (NULL first), role and text. They stream through a task
    sorted by Spark; what is held is a byte and a digest per row of one conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[Any] = []
        done: list[tuple[Any, ...]] = []
        schema = None

        def flush() -> pa.RecordBatch:
            columns = zip(*done)
            types = [pa.int64()] * len(NUMBERS) + [pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays([pa.array(ids, schema), *arrays], ["conv_id", *NUMBERS, "audit"])

        report = None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            for conv, turn, role, text, copies in _values([batch]):
                if report is None or conv != ids[-1]:
                    if report is not None:
                        done.append(report.row())
                    if len(done) >= 1000:
                        yield flush()
                        ids, done = [], []
                    report = Report()
                    ids.append(conv)
                for _ in range(copies):
                    report.add(turn, role, text)
        if report is not None:
            done.append(report.row())
            yield flush()

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), *ORDER)
    counts = ", ".join(f"{c} long" for c in NUMBERS)
    return ordered.mapInArrow(planned, f"conv_id {kind}, {counts}, audit string")


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The edit, role and text of every repaired row."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = SPEAKERS[role[0]] if edit == "K" else NEXT[state]
        yield edit, role if edit == "K" else NAMES[state], text


def repair_conversations(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows ``conv_id, position, role, text, edit`` of the repaired conversations, in order within their task.

    ``plans`` comes from :func:`repair_plans` on the same rows. A conversation's plan and rows stream by, plan
    first; no text is held.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    heads = plans.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
        F.lit(1).alias("copies"), F.lit(0).alias("kind"),
    )
    both = rows.filter("copies > 0").withColumn("kind", F.lit(1)).unionByName(heads)

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = chain.from_iterable(([] for _ in ()))
        first = next(batches, None)
        if first is None:
            return
        schema = first.schema.field("conv_id").type
        stream = _values(chain([first], batches))
        waiting = next(stream, None)

        def of_conversation() -> Iterator[tuple[str, str]]:
            # Ends before the next plan, which stays waiting.
            nonlocal waiting
            while (waiting := next(stream, None)) is not None and waiting[5] == 1:
                for _ in range(waiting[4]):
                    yield waiting[2], waiting[3]

        out: list[tuple[Any, ...]] = []
        held = 0
        while waiting is not None:
            conv, audit = waiting[0], waiting[3]
            own = of_conversation()
            for position, (edit, role, text) in enumerate(_edited(audit, own)):
                out.append((conv, position, role, text, edit))
                held += len(text)
                if held > 1 << 22 or len(out) >= 10_000:
                    yield _turns(out, schema)
                    out, held = [], 0
            for _ in own:
                raise ValueError("the plan does not fit the conversation")
        if out:
            yield _turns(out, schema)

    ordered = both.repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), *ORDER
    )
    return ordered.mapInArrow(repaired, f"conv_id {kind}, position long, role string, text string, edit string")


def _turns(out: list[tuple[Any, ...]], schema: pa.DataType) -> pa.RecordBatch:
    types = [schema, pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "position", "role", "text", "edit"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _digests(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, repaired_sha256`` of conversations whose rows stream by in order."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[Any] = []
        sums: list[Any] = []
        schema = None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            for conv, position, role, text, _ in _values([batch]):
                if position == 0:
                    ids.append(conv)
                    sums.append(hashlib.sha256())
                sums[-1].update(f"{chr(10) if position else ''}{role}:{text}".encode())
            if len(ids) > 1000:
                yield _digest_batch(ids[:-1], sums[:-1], schema)
                ids, sums = ids[-1:], sums[-1:]
        if ids:
            yield _digest_batch(ids, sums, schema)

    return turns.mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


def _digest_batch(ids: list[Any], sums: list[Any], schema: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array(ids, schema), pa.array([s.hexdigest() for s in sums])]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])


def repair_report(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans, with the hash of each repaired conversation: ``role:text`` lines joined by newlines."""
    digests = _digests(repair_conversations(rows, plans)).withColumnRenamed("conv_id", "of")
    found = plans.join(digests, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", *NUMBERS, "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")
    )
