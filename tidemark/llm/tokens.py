"""Token counts and token ids by public tokenizers (op 4, and the input of packing).

The tokenizer library encodes everything. Since the pieces of a text (its
"pre-tokens") are encoded independently of each other, a worker remembers the ids of
the pieces it has seen, in a dictionary of bounded size, and passes only new pieces to
the library's model. Texts outside the plain characters below, and texts that
hold a special token's string, go to the library as they are.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, texts_of

# --- fixed values -----------------------------------------------------------
# Letters and numbers among the characters up to U+00FF
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
# How a byte-level and a word-level vocabulary split text into pieces
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PIECES = rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
WORD_PIECES = rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"
# The splitting rule of the word-level file, as its configuration states it
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ----------------------------------------------------------------------------

# Characters for which the expressions above and the library's agree.
OTHER = re.compile(r"[^\t\n\r -~¡-ÿ]")
# A blank between two visible characters always ends a piece.
CUT = re.compile(r"[!-~¡-ÿ] [!-~¡-ÿ]")
CHUNK = 1 << 20
MEMO_PIECES = 250_000


def safe_chunks(text: str, size: int = CHUNK) -> list[str]:
    """Cut a long text where no token can span: before a blank between visible characters."""
    chunks, start = [], 0
    while len(text) - start > size:
        found = CUT.search(text, start + size)
        if found is None:
            break
        chunks.append(text[start : found.start() + 1])
        start = found.start() + 1
    chunks.append(text[start:])
    return chunks


class TextEncoder:
    """Encode whole texts, without special tokens being added."""

    def __init__(self, path: str):
        self.memo: dict[str, bytes] = {}
        self.pattern = None
        self.lower = False
        self.specials: list[str] = []
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.batch = lambda texts: model.encode(texts, num_threads=1)
            self.chunks = lambda text: [text]
            return
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.batch = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.specials = [t["content"] for t in config["added_tokens"]]
        kinds = self._kinds(config)
        if kinds:
            self.pattern, self.lower = re.compile(BYTE_PIECES if kinds == "byte" else WORD_PIECES), kinds == "word"
            # The library's own step from characters to byte symbols, asked once per character.
            symbols = ByteLevel(add_prefix_space=False, use_regex=False)
            plain = [c for c in map(chr, range(256)) if not OTHER.match(c)]
            table = str.maketrans({c: symbols.pre_tokenize_str(c)[0][0] for c in plain})
            model = tokenizer.model
            self.piece = lambda p: [t.id for t in model.tokenize(p.translate(table))]
        self.chunks = safe_chunks if self.pattern else (lambda text: [text])

    @staticmethod
    def _kinds(config: dict) -> str:
        """Which of the known splitting rules a tokenizer file follows, if any."""
        normalizer, splitter = config.get("normalizer"), config.get("pre_tokenizer") or {}
        if normalizer is None and splitter.get("type") == "ByteLevel":
            plain = splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            return "byte" if plain else ""
        steps = [s.get("type") for s in (normalizer or {}).get("normalizers", [])]
        rules = [s.get("pattern", {}).get("Regex") for s in splitter.get("pretokenizers", [])]
        return "word" if steps == ["NFC", "Replace", "Lowercase"] and rules == [WORD_RULE, None] else ""

    def _pieces(self, text: str) -> list[str] | None:
        if self.pattern is None or OTHER.search(text) or any(s in text for s in self.specials):
            return None
        return self.pattern.findall(text.lower() if self.lower else text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        chunks = [self.chunks(t) for t in texts]
        pieces = [[self._pieces(c) for c in row] for row in chunks]
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        for piece in set(chain.from_iterable(p for row in pieces for p in row if p)).difference(self.memo):
            ids = self.piece(piece)
            self.memo[piece] = struct.pack(f"<{len(ids)}I", *ids)
        whole = [c for row, found in zip(chunks, pieces) for c, p in zip(row, found) if p is None]
        rest = iter(self.batch(whole) if whole else ())
        known = self.memo.__getitem__
        return [
            b"".join(np.array(next(rest), "<u4").tobytes() if p is None else b"".join(map(known, p)) for p in row)
            for row in pieces
        ]


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TextEncoder(path)


def _encoded(df: DataFrame, text: str, path: str, column: str, kind: str, value, slice_bytes: int) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).schema.add(column, kind)
    arrow = {"long": pa.int64(), "binary": pa.binary()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in byte_slices(batches, text, slice_bytes):
            made = pa.array([value(ids) for ids in encode(texts_of(batch, text))], arrow)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), made], [*kept, column])

    return df.select(*kept, text).mapInArrow(run, schema)


def count_tokens(
    df: DataFrame, path: str, text: str = "text", column: str = "n_tokens", slice_bytes: int = 1 << 20
) -> DataFrame:
    """Replace the text column by the number of tokens of the whole text.

    ``path`` names a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file that every
    executor can open. Batches hold about ``slice_bytes`` of text. Only lengths leave the
    function. NULL and empty texts have 0 tokens; very long texts are cut at safe places
    and counted in full. Other columns pass through; the name ``column`` must be free.
    """
    return _encoded(df, text, path, column, "long", lambda ids: len(ids) // 4, slice_bytes)


def token_report(df: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens)."""
    sized: Column = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = df.select(F.col(doc_id).alias("doc_id"), sized.alias("n_bytes"), F.col(text).alias("text"))
    return count_tokens(rows, path).withColumn("over_limit", F.col("n_tokens") > limit)
