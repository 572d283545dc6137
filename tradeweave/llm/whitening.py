"""Embedding whitening with exact cross-products from bit-sliced columns.

1. Entries become whole numbers; equal vectors are folded to one by an
   aggregation, so a vector that holds a third of all rows is one row.
2. Scatter: each task shifts a dimension of a batch to start at 0, packs its bit
   planes across rows into 64-bit words, and gets the sum of products of two
   dimensions as the counts of set bits of their ANDed planes, weighted by
   2 ** (sum of the places). A plane of ones next to them gives sums and rows.
   Tasks send a triangle of the dimensions, never rows.
3. The driver adds the triangles, whose size depends on the dimensions alone,
   centres them as whole numbers of any length (n * sum of products - product of
   sums), and only then divides and solves for the components.
4. A second pass projects the rows. The covariance of the whitened fit list is
   measured on what was projected.

Defined results: rows whose vector is null, empty, or holds a null or non-finite
entry are left out, and so are vectors that have another length than most (the
longer of two equally frequent ones counts); entries beyond a long when scaled
stop at its ends; components of no variance (at most 1e-12 of the whole) cannot
be whitened and are left out, so one distinct vector gives no rows; repeated
rows and null ids keep their own rows; ``deviation`` is null beyond 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: Least share of the variance that a component needs.
LEAST = 1e-12
#: Products of sums leave tasks in limbs of this many bits, so that sums of them stay exact.
LIMB, LIMBS = 40, 4


def quantized(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` (array of longs) of the rows with a whole, finite vector."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long"))
    rows = vectors.select("vec_id", entries.alias("embedding")).where(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))
    return rows.select("vec_id", x.alias("x"))


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes (plane x 64-row word) of each dimension in turn, and how many each has.

    The dimensions are followed by one of ones.
    """
    rows, width = shifted.shape
    deep = [int(x).bit_length() for x in shifted.max(axis=0)]
    words = -(-rows // 64)
    sliced = np.zeros((max(deep, default=0), width + 1, words * 8), np.uint8)
    for place in range(max(deep)):
        bits = ((shifted >> np.uint64(place)) & np.uint64(1)).astype(np.uint8)
        sliced[place, :width, : -(-rows // 8)] = np.packbits(bits, axis=0).T
    ones = np.zeros((1, words * 8), np.uint8)
    ones[0, : -(-rows // 8)] = np.packbits(np.ones(rows, np.uint8))
    out = np.concatenate([*(sliced[: deep[j], j] for j in range(width)), ones])
    return out.view(np.uint64), np.array([*deep, 1])


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of all columns of ``x`` and one of ones (Python ints, upper triangle)."""
    rows, width = x.shape
    low = x.min(axis=0)
    shifted = x.view(np.uint64) - low.view(np.uint64)  # modulo 2 ** 64, so right for any longs
    words, deep = planes(shifted)
    # longs hold the weighted counts unless values are very large
    kind = np.int64 if rows.bit_length() + 2 * int(deep.max()) <= 62 else object
    start = np.concatenate(([0], np.cumsum(deep)))
    places = np.concatenate([np.arange(d) for d in deep])
    weights = np.array([1 << int(p) for p in places], kind)
    product = np.zeros((width + 1, width + 1), object)
    for j in np.flatnonzero(deep):
        later = np.flatnonzero(deep[j:]) + j
        total = np.zeros(len(later), kind)
        for place in range(deep[j]):
            counts = np.bitwise_count(words[start[j] :] & words[start[j] + place]).sum(axis=1, dtype=np.int64)
            weighted = counts.astype(kind) * weights[start[j] :]
            total = total + np.add.reduceat(weighted, start[later] - start[j]) * (1 << place)
        product[j, later] = total.astype(object)
    # undo the shift: x = shifted + low
    base = np.array([*low.tolist(), 0], object)
    sums = np.array([product[j, width] for j in range(width)] + [rows], object)
    return product + np.triu(np.outer(base, sums) + np.outer(sums, base) + rows * np.outer(base, base))


def cross_products(fit: DataFrame, width: int) -> DataFrame:
    """``i, j`` and limbs of the exact cross-products, summed over all tasks."""
    limbs = [f"limb{k}" for k in range(LIMBS)]
    last = LIMBS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = scatter(matrix(batch, width))
                total = own if total is None else total + own
        if total is not None:
            for i in range(width + 1):
                row = total[i, i:]
                cut = [[int(v) >> LIMB * k if k == last else (int(v) >> LIMB * k) & ((1 << LIMB) - 1) for v in row] for k in range(LIMBS)]
                arrays = [pa.array([i] * len(row), pa.int32()), pa.array(range(i, width + 1), pa.int32())]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(c, pa.int64()) for c in cut]], ["i", "j", *limbs])

    parts = fit.select("x").mapInArrow(run, "i int, j int, " + ", ".join(f"{c} long" for c in limbs))
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs])


@dataclass(frozen=True)
class Whitening:
    """A fitted model; its size depends on the dimensions alone."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # dimension x component
    values: np.ndarray  # eigenvalues of the components
    trace: float

    def whitened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact deviations and whitened projections of rows of ``x``."""
        most = max(abs(int(x.min())), abs(int(x.max()))) * self.n + max(map(abs, self.sums))
        kind = np.int64 if 2 * most.bit_length() + len(self.sums).bit_length() <= 62 else object
        apart = x.astype(kind) * self.n - np.array(self.sums, kind)
        centred = apart.astype(np.float64) / self.n
        return (apart * apart).sum(axis=1), centred @ self.axes / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, width: int, wanted: int = COMPONENTS) -> Whitening:
    """The model of distinct vectors ``x`` of ``width`` entries (at least one)."""
    product = np.zeros((width + 1, width + 1), object)
    # at most (width + 1) ** 2 / 2 rows, whatever the input
    for r in cross_products(fit, width).collect():
        product[r["i"], r["j"]] = product[r["j"], r["i"]] = sum(r[f"limb{k}"] << LIMB * k for k in range(LIMBS))
    n, sums = product[width, width], [product[j, width] for j in range(width)]
    centred = [[n * product[i, j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    values, axes = np.linalg.eigh(covariance)
    trace = sum(centred[i][i] for i in range(width)) / (n * n)
    best = [k for k in range(width - 1, -1, -1) if values[k] > LEAST * trace][:wanted]
    return Whitening(n, tuple(sums), axes[:, best], values[best], trace)


def projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` (``vec_id, x``) with ``deviation`` and ``whitened``, an array with an entry a component."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    big = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            deviation, white = model.whitened(matrix(batch, len(model.sums)))
            if deviation.dtype == object:
                exact = pa.array([Decimal(int(d)) if d < 10**38 else None for d in deviation], big)
            else:
                exact = pa.array(deviation).cast(big)
            lists = pa.array(list(white), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), exact, lists], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    k = len(model.values)
    white = projected(fit.select(F.lit(0).alias("vec_id"), "x"), model)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def whitening(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row for each kept vector and component; see the contract of the query."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = stored(quantized(vectors), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("width")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    width = most["width"] if most else 0
    rows = rows.where(F.size("x") == width)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, width, wanted) if most else None
    if model is None or not len(model.values):
        empty = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    error = identity_error(fit, model)
    explained = F.lit([float(v / model.trace) for v in model.values])
    each = projected(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "white"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("white").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
