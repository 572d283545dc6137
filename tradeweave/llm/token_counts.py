"""Token counts of sections by offset-mapped attribution.

A document is encoded once, whole. The bytes of its tokens, summed up, give
each token's span; sections (lines of the text, or fields joined to one text)
have spans of their own; the two are joined as intervals by binary search. A
token that crosses a boundary is allocated by an explicit rule:

* ``most``: to the section that holds most of its bytes, the first among equals;
* ``start``: to the section in which it starts;
* ``share``: to each section by its share of the token's bytes.

A line break belongs to the line it ends. Byte spans are used throughout: a
token may hold part of a character, and every byte has exactly one token.

Defined results: null and empty texts have one empty section with no tokens;
strings of special tokens are ordinary text here, as the count is of the text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import sliced, strings

RULES = ("most", "start", "share")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The encoder and the size in bytes of each token."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def allocate(ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section.

    ``ends``: where each token ends; ``bounds``: where each section ends, the
    last being the end of the text.
    """
    counts = np.zeros(len(bounds))
    if not len(ends):
        return counts
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(bounds, starts, "right")
    last = np.searchsorted(bounds, ends - 1, "right")
    if rule == "start":
        np.add.at(counts, first, 1)
        return counts
    inside = first == last
    np.add.at(counts, first[inside], 1)
    for i in np.flatnonzero(~inside):
        own = np.arange(first[i], last[i] + 1)
        low = np.maximum(starts[i], np.concatenate(([0], bounds))[own])
        held = np.minimum(ends[i], bounds[own]) - low
        if rule == "most":
            counts[own[held.argmax()]] += 1
        else:
            counts[own] += held / held.sum()
    return counts


def section_tokens(docs: DataFrame, rule: str = "most", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, section, n_bytes, n_chars, n_tokens`` for every line of a text."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sizes = encoder(path)
        for batch in sliced(batches, "text"):
            at, section, n_bytes, n_chars, n_tokens = [], [], [], [], []
            for i, text in enumerate(strings(batch, "text")):
                lines = text.split("\n")
                ended = [len(x) + 1 for x in lines[:-1]] + [len(lines[-1])]
                held = np.array([len(x.encode()) + 1 for x in lines[:-1]] + [len(lines[-1].encode())], np.int64)
                ends = np.cumsum(sizes[own.encode_to_numpy(text, disallowed_special=())])
                at += [i] * len(lines)
                section += range(len(lines))
                n_bytes.append(held)
                n_chars += ended
                n_tokens.append(allocate(ends, np.cumsum(held), rule))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(section, pa.int64()),
                    pa.array(np.concatenate(n_bytes)),
                    pa.array(n_chars, pa.int64()),
                    pa.array(np.concatenate(n_tokens)),
                ],
                ["doc_id", "section", "n_bytes", "n_chars", "n_tokens"],
            )

    schema = f"doc_id {kind}, section long, n_bytes long, n_chars long, n_tokens double"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
