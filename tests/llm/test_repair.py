"""Repair of conversations: exhaustive search, a plain version of the whole query, awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair
from tidemark.llm.repair import cheapest_edits, damage_rows, repair_conversations, repair_plans, repair_report

CODES = [0, 1, 2, 3, 2, 3, 4, 6, 7, 8, 9, 10, 11]
LEGAL = re.compile("(s?(ua)+)?")


def choices(rows, most_inserts):
    """All edits, as (cost, audit, initials); ``rows`` are (initial, must go, truncated)."""

    def walk(i, inserts):
        if i == len(rows):
            yield 0, "", ""
        else:
            initial, gone, cut = rows[i]
            for c, a, s in walk(i + 1, inserts):
                yield c + 4, "D" + a, s
                if not gone:
                    extra = 3 * cut
                    if initial:
                        yield c + extra, "K" + a, initial + s
                    for role in "ua":
                        yield c + 3 + extra, "R" + a, role + s
        if inserts:
            for c, a, s in walk(i, inserts - 1):
                for role in "ua":
                    yield c + 3, "I" + a, role + s

    return walk(0, most_inserts)


def test_edits_equal_exhaustive_search():
    random.seed(3)
    for _ in range(150):
        facts = bytes(random.choice(CODES) for _ in range(random.randint(0, 4)))
        rows = [(" sua"[f & 3].strip(), bool(f & 4), bool(f & 8)) for f in facts]
        legal = [(c, a) for c, a, s in choices(rows, 2) if LEGAL.fullmatch(s)]
        assert cheapest_edits(facts) == min(legal)


def plain_edits(facts):
    """Least (cost, audit) by row and last speaker."""
    then = [2, 2, 3, 2]

    def inserted(best):
        for _ in range(3):
            for s in list(best):
                label = (best[s][0] + 3, best[s][1] + "I")
                best[then[s]] = min(best.get(then[s], label), label)
        return best

    best = inserted({0: (0, "")})
    for f in facts:
        found = {}
        for s, (cost, audit) in best.items():
            moves = [(s, 4, "D")]
            if not f & 4:
                extra, who = 3 * bool(f & 8), f & 3
                moves.append((then[s], 3 + extra, "R"))
                if who and (who == then[s] or (who, s) == (1, 0)):
                    moves.append((who, extra, "K"))
            for to, more, edit in moves:
                label = (cost + more, audit + edit)
                found[to] = min(found.get(to, label), label)
        best = inserted(found)
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("loose", [False, True])
def test_edits_equal_a_table(monkeypatch, loose):
    if loose:  # worse bounds cost time, not results
        bounds = repair.suffix_bounds
        monkeypatch.setattr(repair, "suffix_bounds", lambda f: ([0] * (len(f) + 1), bounds(f)[1] + 5))
    random.seed(4)
    for n in [*range(12)] * 20 + ([] if loose else [300, 2000]):
        facts = bytes(random.choice(CODES) for _ in range(n))
        assert cheapest_edits(facts) == plain_edits(facts)


def plain(rows):
    """The report of every conversation, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            row = (turn, "user" if h == 4 else role, text)
            damaged += [row] * (0 if h == 0 else 2 if h == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in damaged if t is not None}
        faults, seen = [], set()
        for _, role, text in damaged:
            words = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else " ")
            seen.add((role, text))
        facts = bytes(
            {"s": 1, "u": 2, "a": 3}.get(r[1][:1], 0) | 4 * (f in "bd") | 8 * (f == "t") for r, f in zip(damaged, faults)
        )
        cost, audit = plain_edits(facts)
        left, lines, state = iter(damaged), [], 0
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit != "D":
                state = {"s": 1, "u": 2, "a": 3}[row[1][0]] if edit == "K" else [2, 2, 3, 2][state]
                role = row[1] if edit == "K" else [None, "system", "user", "assistant"][state]
                lines.append(f"{role}:{row[2] if row else ''}")
        initials = [r[1][:1] for r in damaged]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(x) for x in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def awkward():
    random.seed(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "admin", "User"]
    texts = ["Yes.", "No!", "What", "", " \t\n", None, "a\nb?", "é…", "\x85"]
    rows = [
        (c, random.choice([None, *range(12)]), random.choice(roles), random.choice(texts) if random.random() < 0.5 else f"t{i}.")
        for c in [None, *range(60)]
        for i in range(random.randint(1, 9))
    ]
    rows += [(100, i, "user" if i % 2 else "assistant", f"turn {i}.") for i in range(3000)]  # a long one
    rows += [(101, 1, "user", "x. " * 100_000), (102, 2**40, "user", "a."), (102, -5, "assistant", "a.")]
    return rows + rows[:20]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(awkward(), "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(c) for c in ("copies", "kind", "audit", "position", "of", "edit", "gaps")})


def test_report_equals_a_plain_version(table):
    rows = damage_rows(table)
    got = repair_report(rows, repair_plans(rows)).collect()
    want = plain(awkward())
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_repaired_conversations_are_legal(table):
    rows = damage_rows(table)
    turns = repair_conversations(rows, repair_plans(rows)).collect()
    by = {}
    for r in turns:
        assert r.position == len(by.setdefault(r.conv_id, []))
        by[r.conv_id].append(r.role[0])
    assert all(LEGAL.fullmatch("".join(x)) for x in by.values())


def test_empty_table(table):
    rows = damage_rows(table.limit(0))
    assert repair_report(rows, repair_plans(rows)).collect() == []
