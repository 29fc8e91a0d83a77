"""Removal of common lines: brute force, hot lines, awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lines
from tidemark.llm.lines import PerfectHash, drop_common_lines

WHITE = " \t\n\x0b\x0c\r"
LONG = [f"Line number {i} of those that Many documents share, Été." for i in range(6)]


def brute(rows, least_chars=40, least_docs=5):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))

    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k].append(doc_id)
    out = []
    for doc_id, text in rows:
        cut = (text or "").split("\n")
        kept = []
        for x in cut:
            held = holders.get(key(x), [])
            last = max((h for h in held if h is not None), default=None)
            if len(held) < least_docs or doc_id == last:
                kept.append(x)
        new = "\n".join(kept)
        out.append((doc_id, None if text is None else new, len(cut), len(cut) - len(kept), hashlib.sha256(new.encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def awkward():
    rows = [(i, "\n".join(LONG[: 1 + i % 6])) for i in range(30)]
    rows += [(i, f"  {LONG[0].upper()}\t\r\nshort\n{LONG[0]}") for i in range(30, 34)]  # É is no a-z letter
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, "x" * 200_000 + "\n" + LONG[1]), (44, "\n".join(LONG * 300))]
    rows += [(7, LONG[2]), (7, LONG[2]), (44, LONG[3]), (None, LONG[1]), (None, None)]
    rows += [(None, "Only rows without any id have this line, five times.")] * 5
    rows += [(50, "\x85" + "y" * 39), (51, "y" * 39 + "　")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(awkward(), "doc_id long, text string")
    clashing = ("h", "print", "hs", "prints", "version", "shard", "part", "known", "carried", "n_lines", "hit_id")
    return df.withColumns({c: F.lit(c) for c in clashing})


def test_equals_brute_force(docs, monkeypatch):
    got = drop_common_lines(docs).select("doc_id", "text", "n_lines", "n_dropped", "kept_sha256").collect()
    assert ordered(got) == ordered(brute(awkward()))
    # Many shards, and hot ones in parts.
    monkeypatch.setattr(lines, "SHARD_KEYS", 1)
    monkeypatch.setattr(lines, "PART_PROBES", 3)
    got = drop_common_lines(docs, least_chars=3, least_docs=2, carry=("shard",)).collect()
    assert {r.shard for r in got} == {"shard"}
    assert ordered(tuple(r)[:5] for r in got) == ordered(brute(awkward(), 3, 2))


def test_empty_table(docs):
    assert drop_common_lines(docs.limit(0)).collect() == []
    assert drop_common_lines(docs.filter("doc_id = 40")).select("text", "n_lines", "n_dropped").collect() == [(None, 1, 0)]


def test_numbers_are_minimal_and_perfect():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 5000):
        h, print_ = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
        if n > 2:
            h[: n // 2] = h[0]  # equal first words: the second one tells them apart
        sizes, packed = PerfectHash.build(h, print_).to_bytes()
        again = PerfectHash.from_bytes(sizes, packed)
        assert sorted(again.number(h, print_).tolist()) == list(range(n))
        others = again.number(*rng.integers(0, 2**64, (2, 100), dtype=np.uint64))
        assert ((others >= -1) & (others < max(n, 1))).all()
