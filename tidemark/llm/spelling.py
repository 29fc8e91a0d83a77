"""Grouping of spelling variants with a trie of letter counts (op 11)."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices
from tidemark.operators.staging import stage

GROUPS = 12
# Bytes of words that one task holds in its trie.
CELL_BYTES = 1 << 18
# A node with this many words at most is a leaf: its words are verified.
LEAF = 12
# Distinct words that one task counts before it hands them on.
COUNTED = 200_000

RUN = "[A-Za-zÀ-ÿ]{%d,}"


def damaged(runs: list[str], doc_id: str) -> list[str]:
    """Runs without one letter each, where the crc32 of ``<doc_id>:<run>`` is divisible by 31."""
    start = zlib.crc32(f"{doc_id}:".encode())
    hashes = [zlib.crc32(run.encode(), start) for run in runs]
    return [run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :] for run, h in zip(runs, hashes)]


def count_words(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 7, damage: bool = True
) -> DataFrame:
    """Rows ``word, n``: runs of Latin letters of at least ``least_chars`` code points, A-Z in lower case.

    With ``damage``, runs lose a letter as :func:`damaged` says, before their length counts.
    """
    # Shorter runs cannot give a word; a maximal run is found whole or not at all.
    runs = re.compile(RUN % least_chars)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in counts if len(w) >= least_chars]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for batch in byte_slices(batches, "text"):
            lowered = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
            for i, one in zip(batch.column("doc_id").to_pylist(), lowered.to_pylist()):
                found = runs.findall(one)
                counts.update(damaged(found, i) if damage else found)
                if len(counts) >= COUNTED:
                    yield flush()
        if counts:
            yield flush()

    rows = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """Letters dealt to groups of about equal weight, most frequent first.

    The driver sees one row per letter of the alphabet (under 130).
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
    weights = {r["letter"]: r["n"] for r in letters.groupBy("letter").agg(F.count("*").alias("n")).collect()}
    dealt, held = [""] * groups, [0] * groups
    for letter in sorted(weights, key=lambda c: (-weights[c], c)):
        least = held.index(min(held))
        dealt[least] += letter
        held[least] += weights[letter]
    return dealt


def _cell(groups: list[str]) -> list[Column]:
    """First levels of the trie: the length, then the counts of the first groups."""
    word = F.col("word")
    counts = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in groups]
    return [F.length(word), *counts]


def _steps(depth: int) -> list[list[int]]:
    """What the first ``depth`` counts of a near word can differ by, each pair of words once.

    The first number is the difference in length. A longer word has a surplus of one in some
    group; a word of equal length also has a deficit of one elsewhere, and of the two
    the one whose first difference is a deficit looks for the other. Differences in later groups
    leave the first ones as they are.
    """
    units = [[int(i == j) for j in range(depth)] for i in range(depth)]
    none = [0] * depth
    longer = [[1, *u] for u in [none, *units]]
    swapped = [
        [a - b for a, b in zip(units[i], units[j])] for i in range(depth) for j in range(i + 1, depth)
    ]
    return longer + [[0, *u] for u in [none, *units, *swapped]]


def _letters(words: pa.Array) -> np.ndarray:
    """Words of equal length as a matrix; every letter is one byte of Latin-1."""
    width = len(words[0].as_py())
    return np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8).reshape(-1, width)


def _vectors(letters: np.ndarray, group_of: np.ndarray, groups: int) -> np.ndarray:
    n = len(letters)
    where = np.arange(n)[:, None] * groups + group_of[letters]
    return np.bincount(where.ravel(), minlength=n * groups).reshape(n, groups).astype(np.int16)


def one_edit(resident: np.ndarray, visitor: np.ndarray) -> np.ndarray:
    """Which words differ by exactly one edit: residents in rows, visitors in columns.

    Words are rows of letters; the visitors are as long as the residents, or shorter by one.
    """
    a, b = resident[:, None, :], visitor[None, :, :]
    width = visitor.shape[1]
    if resident.shape[1] == width:
        return np.count_nonzero(a != b, axis=2) == 1
    front, back = a[:, :, :width] != b, a[:, :, 1:] != b
    # The letter to leave out lies behind the last difference from the right, and not behind the first one from the left.
    first = np.where(front.any(axis=2), front.argmax(axis=2), width)
    last = np.where(back.any(axis=2), width - 1 - back[:, :, ::-1].argmax(axis=2), -1)
    return last < first


def search(residents: np.ndarray, visitors: np.ndarray, group_of: np.ndarray, groups: int) -> np.ndarray:
    """Pairs (resident, visitor) of positions of words that are one edit apart.

    The trie: residents in the order of their count vectors, so that a node is a stretch of rows that share
    the first counts. The search goes depth first with an explicit stack; a node holds the visitors that
    reach it, with what they have spent of a surplus and a deficit of one. A node with few words, or
    without levels below, is a leaf, whose words are compared with the visitors letter by letter.
    """
    tree = _vectors(residents, group_of, groups)
    order = np.lexsort(tree.T[::-1])
    tree, rows = tree[order], residents[order]
    asked = _vectors(visitors, group_of, groups)
    everyone = np.arange(len(visitors))
    nothing = np.zeros(len(visitors), np.int16)
    stack = [(0, 0, len(rows), everyone, nothing, nothing)]
    found = [np.zeros((0, 2), np.int64)]
    while stack:
        level, low, high, who, surplus, deficit = stack.pop()
        if level == groups or high - low <= LEAF:
            step = max(1, (1 << 22) // (len(who) * rows.shape[1]))
            for at in range(low, high, step):
                r, v = np.nonzero(one_edit(rows[at : min(at + step, high)], visitors[who]))
                found.append(np.stack([order[at + r], who[v]], axis=1))
            continue
        counts = tree[low:high, level]
        edges = [0, *(np.flatnonzero(counts[1:] != counts[:-1]) + 1).tolist(), high - low]
        for start, end in zip(edges, edges[1:]):
            more = counts[start] - asked[who, level]
            now, then = surplus + np.maximum(more, 0), deficit + np.maximum(-more, 0)
            can = (now <= 1) & (then <= 1)
            if can.any():
                stack.append((level + 1, low + start, low + end, who[can], now[can], then[can]))
    return np.concatenate(found)


def near_words(words: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Rows ``word, n, near, near_n``: all pairs of words that are one inserted, deleted or replaced letter apart, both ways.

    ``words`` has distinct ``word`` and ``n``, all letters within Latin-1. The top of the trie is dealt out: the length and the
    counts of the first groups name a cell, as many groups as bring the largest cell below ``cell_bytes``. Words
    stay in their cell and visit those within reach of the budget. A cell that is larger even with
    half of the groups is cut into blocks, all of which its visitors see, so nothing is left out. Each task
    holds the lower part of the trie for its cell.
    """
    groups = letter_groups(words)
    group_of = np.zeros(256, np.int64)
    for g, letters in enumerate(groups):
        group_of[[ord(c) for c in letters]] = g
    levels = len(groups)

    most = levels // 2
    names = ["length", *(f"c{i}" for i in range(most))]
    counted = words.select(F.length("word").alias("bytes"), *(c.alias(n) for c, n in zip(_cell(groups[:most]), names)))
    cells = stage(counted.groupBy(*names).agg(F.sum("bytes").alias("bytes")), "cells")
    # The largest cell of every depth: one number each.
    by_depth = cells.rollup(*names).agg(F.sum("bytes").alias("bytes"), F.grouping_id().alias("gid"))
    largest = {r["gid"]: r["bytes"] for r in by_depth.groupBy("gid").agg(F.max("bytes").alias("bytes")).collect()}
    depth = next((d for d in range(most) if largest.get((1 << (most - d)) - 1, 0) <= cell_bytes), most)
    names = names[: depth + 1]

    def key(counts: list[Column]) -> Column:
        return F.concat_ws(".", *counts)

    sizes = cells.groupBy(key([F.col(n) for n in names]).alias("cell")).agg(
        F.ceil(F.sum("bytes") / cell_bytes).alias("blocks")
    )
    sizes = stage(sizes, "sizes")
    here = words.select("word", "n", F.array(*_cell(groups[:depth])).alias("counts"))
    own = here.select("word", "n", key([F.col("counts")[i] for i in range(depth + 1)]).alias("cell"))
    residents = own.join(sizes, "cell").select(
        "cell", F.pmod(F.xxhash64("word"), "blocks").alias("block"), "word", "n", F.lit(0).alias("same")
    )
    steps = F.array(*(F.array(*map(F.lit, s)) for s in _steps(depth)))
    goal = F.explode(F.transform(steps, lambda s: F.zip_with("counts", s, lambda a, b: a + b))).alias("goal")
    reached = here.select("word", "n", "counts", goal).filter(F.forall("goal", lambda x: x >= 0))
    visitors = (
        reached.select(
            "word", "n", key([F.col("goal")[i] for i in range(depth + 1)]).alias("cell"),
            F.when(F.col("goal") == F.col("counts"), 2).otherwise(1).alias("same"),
        )
        .join(sizes, "cell")
        .select(
            "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "word", "n", "same"
        )
    )

    def paired(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role, size = table.column("same").to_numpy(), pc.utf8_length(table.column("word")).to_numpy()
        word, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
        at = np.flatnonzero(role == 0)
        out = []
        if len(at):
            letters = _letters(word.take(pa.array(at)))
            for width in (letters.shape[1], letters.shape[1] - 1):
                who = np.flatnonzero((role > 0) & (size == width))
                if not len(who):
                    continue
                pairs = search(letters, _letters(word.take(pa.array(who))), group_of, levels)
                r, v = at[pairs[:, 0]], who[pairs[:, 1]]
                # Two words of one cell visit each other; one visit counts.
                twice = role[v] == 2
                first = pc.less(word.take(pa.array(v)), word.take(pa.array(r))).to_numpy(zero_copy_only=False)
                out.append(np.stack([r, v], axis=1)[~twice | first])
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        a, b = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        columns = [word.take(pa.array(a)), pa.array(n[a]), word.take(pa.array(b)), pa.array(n[b])]
        return pa.table(columns, ["word", "n", "near", "near_n"])

    both = residents.unionByName(visitors)
    return both.groupBy("cell", "block").applyInArrow(paired, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """Rows ``word, root``: the last word that forms lead to from each word with a form.

    Every step multiplies the count by ``ratio`` at least, so ``most`` bounds the steps; each round doubles them.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, most))))):
        later = roots.select(F.col("word").alias("root"), F.col("root").alias("last"))
        roots = stage(roots.join(later, "root", "left").select("word", F.coalesce("last", "root").alias("root")), "roots")
    return roots


def spelling_variants(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = 7,
    least_count: int = 2,
    ratio: int = 10,
    damage: bool = True,
) -> DataFrame:
    """Group the words of a corpus around their most frequent spelling.

    Words are maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case, with at least
    ``least_chars`` code points and ``least_count`` occurrences in all. With ``damage``, runs lose a letter as
    :func:`damaged` says. Two words are near if one inserted, deleted or replaced code point makes them equal.
    Returns ``word, form, root, n, n_near, form_n``, one row per word: ``form`` is the near word
    with the largest count (ties: smallest in code-point order) if that is at least ``ratio``
    times (2 at least) the word's own, else NULL; ``root`` the last word that forms lead to.

    NULL texts have no words; a NULL id counts as an empty one; repeated rows count each. Texts and words
    of any length are taken whole. Extra columns are ignored. An empty table gives no rows.
    """
    words = stage(count_words(df, doc_id, text, least_chars, damage).filter(F.col("n") >= least_count), "words")
    near = near_words(words)
    best = near.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), "near")).alias("best")
    )
    judged = best.select(
        "word",
        "n_near",
        F.when(-F.col("best.neg") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.neg") >= ratio * F.col("n"), -F.col("best.neg")).alias("form_n"),
    )
    judged = stage(judged, "near")
    most = words.agg(F.max("n").alias("n")).first()["n"] or 1
    roots = _roots(judged.filter("form is not null"), int(math.log(most, ratio)) + 1)
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )
