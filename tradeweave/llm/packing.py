"""Packing token sequences by vector bin packing.

A document's ids are cut into pieces of ``length`` tokens and a remainder.
Pieces are dealt by hash into groups of about ``GROUP_PIECES``; in each, a
dot-product heuristic fills one sequence after another: of the pieces that fit
in every dimension (tokens, segments, loss-bearing tokens) it takes the one
whose demand has the largest dot product with what the sequence has left, each
dimension as a share of its limit. Only sizes travel to the groups, never ids.

Groups are independent tasks, so the number of pieces that wait in one is
bounded at any size of the input; each group leaves at most a few sequences
that are not full.

Defined results: null and empty texts have only the end id; strings of special
tokens inside a text become their ids, as in the library; repeated rows are
packed each on its own.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import sliced, stored, strings

LENGTH = 2048
#: Segments and loss-bearing tokens that a sequence may hold.
MAX_SEGMENTS, MAX_LOSS = 512, 2048
END_ID = 1
GROUP_PIECES = 4_000


def default_vocabulary() -> tuple[str, str]:
    """The library's file, and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(vocabulary: tuple[str, str]):
    """Text to ids (numpy), as the library encodes without special tokens added.

    The rank file gives the same ids several times faster; the library's file
    supplies the special tokens that may stand in a text.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary[0], encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    with open(vocabulary[1], "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: own.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, vocabulary: tuple[str, str] | None = None, length: int = LENGTH) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, loss`` for every piece."""
    paths = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(paths)
        for batch in sliced(batches, "text"):
            at, rows = [], []
            for i, text in enumerate(strings(batch, "text")):
                ids = np.append(encode(text), END_ID).astype("<u4")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    at.append(i)
                    # the first id of a document is predicted from nothing and bears no loss
                    rows.append((start, len(part), zlib.crc32(part), len(ids), len(part) - (start == 0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), *[pa.array(c, pa.int64()) for c in zip(*rows)]], ["doc_id", *names]
            )

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def place(sizes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``sizes`` has a row per piece, tokens first."""
    kinds, members = np.unique(sizes, axis=0, return_inverse=True)
    members = members.reshape(-1)
    # the pieces of one kind are interchangeable: last in, first out
    stacks = [[] for _ in kinds]
    for piece, kind in enumerate(members.tolist()):
        stacks[kind].append(piece)
    left = np.array([len(s) for s in stacks])
    shares = kinds / limits
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    now, used = 0, np.zeros(len(limits), np.int64)
    todo = len(sizes)
    while todo:
        room = limits - used
        fits = (left > 0) & (kinds <= room).all(axis=1)
        if not fits.any():
            if not used.any():
                raise ValueError("a piece is larger than a sequence may be")
            now, used = now + 1, np.zeros(len(limits), np.int64)
            continue
        score = np.where(fits, shares @ (room / limits), -1.0)
        best = int(score.argmax())
        piece = stacks[best].pop()
        left[best] -= 1
        sequence[piece], offset[piece] = now, used[0]
        used = used + kinds[best]
        todo -= 1
        if left[best] == 0 and (left == 0).sum() * 2 > len(left):
            alive = np.flatnonzero(left)
            kinds, shares, left, stacks = kinds[alive], shares[alive], left[alive], [stacks[i] for i in alive]
    return sequence, offset


def pack(parts: DataFrame, length: int = LENGTH, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``."""
    parts = stored(parts, "packing-pieces")
    groups = max(1, -(-parts.count() // GROUP_PIECES))
    limits = np.array([length, max_segments, max_loss], np.int64)
    keyed = parts.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # a fixed order: a task that runs again packs alike
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        sizes = np.stack([pdf["length"].to_numpy(), np.ones(len(pdf), np.int64), pdf["loss"].to_numpy()], axis=1)
        sequence, offset = place(sizes, limits)
        return pdf.assign(sequence_id=sequence * groups + int(key[0]), offset=offset)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", sequence_id long, offset long"
    return keyed.groupBy("group").applyInPandas(run, schema).drop("group", "loss")
