"""BPE encoding and decoding with a vocabulary file of a public tokenizer.

Method: contiguous rank array. A word is a list of part ids and, beside it, the
list of the ranks of adjacent pairs. Its minimum is searched again and again;
the boundary there is deleted and the two neighbouring ranks are looked up anew.
Words past ``LONG_WORD`` parts use a heap over a linked list, which merges in
the same order without the quadratic scan.

Texts are cut at white space, which no token crosses; what a piece encodes to
is kept in a bounded table per task, as most pieces recur.

Defined results: null and empty texts give no ids and the empty decoded text;
strings of special tokens inside a text become their ids, as in the library.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import SLICE_BYTES, sliced, strings

LONG_WORD = 200
#: Entries of each table per task, about 60 MB.
TABLE_ENTRIES = 250_000
NO_RANK = 1 << 60
#: The white space of the tokenizer's patterns, a fixed value.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: str.split() also cuts at these.
OTHER_SPACE = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(f"[{SPACE}]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def merge_short(parts: list[int], ranks_of: dict[int, int], merged: list[int]) -> list[int]:
    """Merge with a contiguous array of the ranks of adjacent parts."""
    find = ranks_of.get
    ranks = [find(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while ranks:
        least = min(ranks)
        if least == NO_RANK:
            break
        i = ranks.index(least)
        parts[i] = new = merged[least]
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = find(new << 20 | parts[i + 1], NO_RANK)
        if i:
            ranks[i - 1] = find(parts[i - 1] << 20 | new, NO_RANK)
    return parts


def merge_long(parts: list[int], ranks_of: dict[int, int], merged: list[int]) -> list[int]:
    """The same merges for a long word: lowest rank first, leftmost among equals."""
    size = len(parts)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    alive = [True] * size
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := ranks_of.get(a << 20 | b)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= size or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j] = merged[rank], False
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            if (r := ranks_of.get(parts[i] << 20 | parts[k])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[k]))
        h = before[i]
        if h >= 0 and (r := ranks_of.get(parts[h] << 20 | parts[i])) is not None:
            heapq.heappush(heap, (r, h, parts[h], parts[i]))
    return [p for p, keep in zip(parts, alive) if keep]


class Codec:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ranks_of, self.merged = {}, []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.ranks_of.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.end] for x in letters]
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split)
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.word_table: dict[str, bytes] = {}
        self.piece_table: dict[str, bytes] = {}

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token, little-endian unsigned 32-bit."""
        data = word.encode()
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.last[data[-1]])
        merge = merge_short if len(parts) <= LONG_WORD else merge_long
        return np.array(merge(parts, self.ranks_of, self.merged), "<u4").tobytes()

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a stretch of text without white space inside."""
        # one character at a time: the library knows no final sigma
        text = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        out = []
        for word in self.words.findall(text):
            ids = self.word_table.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(self.word_table) >= TABLE_ENTRIES:
                    self.word_table.clear()
                if len(word) <= LONG_WORD:
                    self.word_table[word] = ids
            out.append(ids)
        ids = b"".join(out)
        if len(self.piece_table) >= TABLE_ENTRIES:
            self.piece_table.clear()
        if len(piece) <= LONG_WORD:
            self.piece_table[piece] = ids
        return ids

    def encode_plain(self, text: str) -> bytes:
        pieces = SPACES.split(text) if OTHER_SPACE.search(text) else text.split()
        find, encode = self.piece_table.get, self.encode_piece
        return b"".join([find(p) or encode(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self.encode_plain(text)
        out, start = [], 0
        for match in self.specials.finditer(text):
            out.append(self.encode_plain(text[start : match.start()]))
            out.append(np.array([self.special[match[0]]], "<u4").tobytes())
            start = match.end()
        return b"".join([*out, self.encode_plain(text[start:])])

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def encode(df: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit)."""
    path = vocabulary or default_vocabulary()
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in sliced(batches, "text"):
            ids = [own.encode(x) for x in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["id", "n_tokens", "ids"],
            )

    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_column)


def decode(df: DataFrame, vocabulary: str | None = None, ids_column: str = "ids") -> DataFrame:
    """All columns of ``df`` and ``decoded``; null ids give the empty text."""
    path = vocabulary or default_vocabulary()
    kept = df.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in sliced(batches, ids_column, SLICE_BYTES):
            texts = [own.decode(x or b"") for x in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("decoded", T.StringType())]))
