"""Jaro-Winkler and Indel ratio, the two similarities Spark does not have.

Both are Arrow-batched pandas UDFs.  A batch is reduced to its distinct string
pairs first; both then work on code-point matrices, so one numpy step advances
thousands of pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed values of the Winkler variant: boost only above this Jaro score, for at
# most this many leading characters, with this weight per character.
BOOST_ABOVE = 0.7
BOOST_CHARS = 4
BOOST_WEIGHT = 0.1

_CHUNK = 4096
_CELLS = 1 << 18


def encode(strings: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as a code-point matrix filled up with ``pad``, plus lengths."""
    lengths = np.fromiter((len(s) for s in strings), dtype=np.int64, count=len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.full((len(strings), max(int(lengths.max(initial=0)), 1)), pad, dtype=np.uint32)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = flat
    return codes, lengths


# Pads lie outside Unicode and differ per side, so padding never matches.
PAD_A, PAD_B = 0xFFFFFFFF, 0xFFFFFFFE


def jaro_winkler_rows(
    a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray
) -> np.ndarray:
    """Row-wise Jaro-Winkler of two encoded blocks (one may have a single row)."""
    n = max(len(a), len(b))
    a, b = np.broadcast_to(a, (n, a.shape[1])), np.broadcast_to(b, (n, b.shape[1]))
    len_a, len_b = np.broadcast_to(len_a, n), np.broadcast_to(len_b, n)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    widest = int(reach.max(initial=0))

    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    for i in range(a.shape[1]):
        lo, hi = max(0, i - widest), min(b.shape[1], i + widest + 1)
        if lo >= hi:
            break
        free = (b[:, lo:hi] == a[:, i : i + 1]) & ~hit_b[:, lo:hi]
        free &= np.abs(np.arange(lo, hi) - i) <= reach[:, None]
        rows = np.flatnonzero(free.any(axis=1))
        hit_b[rows, lo + free[rows].argmax(axis=1)] = True
        hit_a[rows, i] = True

    matches = hit_a.sum(axis=1)
    # Both masks hold the same number of hits per row, so their flat, row-major
    # selections line up and out-of-order characters show as differences.
    moved = np.bincount(
        np.repeat(np.arange(n), matches), weights=a[hit_a] != b[hit_b], minlength=n
    )
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matches / len_a + matches / len_b + (matches - moved // 2) / matches) / 3
    jaro = np.where(matches > 0, jaro, 0.0)
    jaro = np.where((len_a == 0) & (len_b == 0), 1.0, jaro)

    width = min(BOOST_CHARS, a.shape[1], b.shape[1])
    lead = np.cumprod(a[:, :width] == b[:, :width], axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + BOOST_WEIGHT * lead * (1 - jaro), jaro)


def jaro_winkler_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro-Winkler of aligned string lists, in length order to keep blocks tight."""
    out = np.zeros(len(a))
    order = np.argsort([max(len(x), len(y)) for x, y in zip(a, b)], kind="stable")
    for start in range(0, len(order), _CHUNK):
        part = order[start : start + _CHUNK]
        enc_a, len_a = encode([a[i] for i in part], PAD_A)
        enc_b, len_b = encode([b[i] for i in part], PAD_B)
        out[part] = jaro_winkler_rows(enc_a, len_a, enc_b, len_b)
    return out


def indel_rows(a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    """Row-wise 2*LCS/(len a + len b) of two encoded blocks of equal height.

    The LCS is kept as a row of bits per pair, 64 to a word: a bit turns to zero
    where the LCS grows.  One step adds one character of ``b`` for all pairs.
    """
    n, words = len(a), -(-a.shape[1] // 64)
    row = np.full((n, words), ~np.uint64(0))
    same = np.zeros((n, words * 64), dtype=bool)
    for at in range(b.shape[1]):
        np.equal(a, b[:, at : at + 1], out=same[:, : a.shape[1]])
        step = row & np.packbits(same, axis=1, bitorder="little").view(np.uint64)
        kept = row & ~step
        carry = np.zeros(n, dtype=np.uint64)
        for word in range(words):
            total = row[:, word] + step[:, word]
            moved = total + carry
            carry = ((total < step[:, word]) | (moved < total)).astype(np.uint64)
            row[:, word] = moved | kept[:, word]
    common = words * 64 - np.bitwise_count(row).sum(axis=1, dtype=np.int64)
    length = len_a + len_b
    return np.where(length > 0, 2 * common / np.maximum(length, 1), 1.0)


def indel_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """2*LCS/(len a + len b) of aligned string lists, in length order; blocks of
    long texts have fewer rows, so that they stay within ``_CELLS`` characters."""
    out = np.ones(len(a))
    longest = np.array([max(len(x), len(y), 1) for x, y in zip(a, b)], dtype=np.int64)
    order = np.argsort(-longest, kind="stable")
    start = 0
    while start < len(order):
        part = order[start : start + max(1, min(_CHUNK, _CELLS // int(longest[order[start]])))]
        enc_a, len_a = encode([a[i] for i in part], PAD_A)
        enc_b, len_b = encode([b[i] for i in part], PAD_B)
        out[part] = indel_rows(enc_a, len_a, enc_b, len_b)
        start += len(part)
    return out


def _over_distinct_pairs(score, a: pd.Series, b: pd.Series) -> pd.Series:
    """Apply ``score`` to the batch's distinct non-null pairs only."""
    result = np.full(len(a), np.nan)
    known = (a.notna() & b.notna()).to_numpy()
    if known.any():
        code_a, text_a = pd.factorize(a[known])
        code_b, text_b = pd.factorize(b[known])
        pair, back = np.unique(code_a.astype(np.int64) * len(text_b) + code_b, return_inverse=True)
        left = [text_a[i] for i in pair // len(text_b)]
        right = [text_b[i] for i in pair % len(text_b)]
        result[known] = score(left, right)[back]
    return pd.Series(result).astype("Float64").mask(~known)


def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _over_distinct_pairs(jaro_winkler_pairs, a, b)


def _indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _over_distinct_pairs(indel_pairs, a, b)


# Jaro-Winkler similarity over code points; null if either side is null.
jaro_winkler = F.pandas_udf(_jaro_winkler, DoubleType())
# The same for a column that is filtered on and kept: a filter on a
# deterministic UDF column is pushed below it and runs the UDF a second time.
jaro_winkler_once = F.pandas_udf(_jaro_winkler, DoubleType()).asNondeterministic()
# Indel similarity in 0..1; null if either side is null.
indel_ratio = F.pandas_udf(_indel_ratio, DoubleType())


def register_similarity(spark: SparkSession) -> None:
    """Make both functions callable from SQL text."""
    spark.udf.register("jaro_winkler", jaro_winkler)
    spark.udf.register("indel_ratio", indel_ratio)
