"""Spelling variants: brute force over all pairs, small cells and blocks, awkward rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.spelling import near_words, one_edit, spelling_variants


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, ratio=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    near = {w: [v for v in words if is_near(w, v)] for w in words}

    def form(w):
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        return best if best and words[best] >= ratio * words[w] else None

    out = []
    for w, n in words.items():
        root = w
        while form(root):
            root = form(root)
        out.append((w, form(w), root, n, len(near[w]), words.get(form(w))))
    return sorted(out, key=str)


def corpus():
    rng = np.random.default_rng(6)
    base = ["bedeutung", "spelling", "Étrangeÿ", "aaaaaaaa", "variants", "notation", "×÷multiply"]
    rows = []
    for i in range(400):
        word = base[int(rng.integers(len(base)))]
        if rng.random() < 0.25:
            at, letter = int(rng.integers(len(word))), "abeé"[int(rng.integers(4))]
            word = (word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :])[
                int(rng.integers(3))
            ]
        rows.append((i, f"{word} {word.upper()}, {word}-x 7{word}_"))
    rows += [(1000, "bedeutungg " * 500 + "bedeutunggg " * 40 + "aaaaaaaab " * 90), (1003, "bedeutungggg " * 3)]
    rows += [(None, None), (None, "spellingg spellingg"), (5, ""), (6, "one two"), (7, "w" * 3000 + " " + "w" * 3000)]
    rows += [(8, ("w" * 3001 + " ") * 2), (8, ("w" * 3001 + " ") * 2), (9, "İstanbul İstanbul ŉabcdefg ŉabcdefg")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    return df.withColumns({c: F.lit(c) for c in ("word", "n", "near", "form", "root", "cell", "block", "n_near")})


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_equals_brute_force(docs):
    want = brute(corpus())
    assert any(w[2] != w[1] is not None for w in want) and max(w[4] for w in want) > 3
    assert rows_of(spelling_variants(docs)) == want


@pytest.mark.parametrize("cell_bytes,leaf", [(1, 1), (40, 2), (200, 100)])
def test_cells_blocks_and_leaves_lose_no_pair(spark, monkeypatch, cell_bytes, leaf):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    words = sorted({w for w, *_ in brute(corpus()) if len(w) < 50})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = near_words(df, cell_bytes).collect()
    want = sorted((a, words.index(a), b, words.index(b)) for a in words for b in words if is_near(a, b))
    assert sorted(map(tuple, got)) == want


def test_empty_table(docs):
    assert spelling_variants(docs.limit(0)).collect() == []
    assert spelling_variants(docs.filter("text in ('', 'one two') or text is null")).collect() == []


def test_one_edit_is_exact():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2, (200, 6)).astype(np.uint8)
    for width in (6, 5):
        b = rng.integers(0, 2, (200, width)).astype(np.uint8)
        want = [[is_near(x.tobytes(), y.tobytes()) for y in b] for x in a]
        assert one_edit(a, b).tolist() == want
