"""SimHash near-duplicates through tables of distances to reference fingerprints.

1. Each text gets a 64-bit fingerprint: a bit is 1 if more than half of the
   hashes of its three-word shingles (repeats included) have it. Equal
   fingerprints are folded to one row before anything is compared.
2. The distance of two fingerprints is at least the difference of their
   distances to any third one. ``PIVOTS`` reference fingerprints give each
   fingerprint its row of distances; what differs by more than ``REACH`` in one
   place is no pair. Survivors are verified by their differing bits.
3. Which rows meet is decided by distances too. Of four parts of the bits, two
   differing bits leave at least two parts equal, so the distances measured on
   those two parts are equal as well. A fingerprint goes to six cells, one for
   each choice of two parts, keyed by its distances to all references there.
   A cell of more than ``TILE`` rows is cut the same way by the bits not yet
   fixed: 32, 16 and at last 8 open bits, so no cell stays large, whatever the
   input, and no pair is lost.
4. Components come from star contraction over the links.

Defined results: a null text is empty; an empty one has fingerprint zero and is
linked like any other; fewer than three words are one shingle; repeated rows
share a fingerprint; rows with a null id are linked but name a component only
if it has no other id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import raw_bytes, sliced, stored
from tradeweave.llm.jaccard import Component, components

N = 3
SEED = 42
#: Differing bits of a link.
REACH = 2
TILE = 512
PIVOTS = 16
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def reference(i: int) -> int:
    return np.uint64(xxhash.xxh64_intdigest(f"pivot {i}".encode())).view(np.int64).item()


REFERENCES = [reference(i) for i in range(PIVOTS)]


def fingerprint(text: bytes) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(N, len(words))
    count = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[size - 1 :].tolist())), np.uint64, count
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, count, BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0].item()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every document; ``fp`` is a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [fingerprint(x) for x in raw_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def finer(fixed: int, width: int) -> list[int]:
    """Masks that fix two of four parts, of ``width`` bits each, of what ``fixed`` leaves open."""
    open_bits = [b for b in range(64) if not fixed >> b & 1]
    parts = [sum(1 << b for b in open_bits[at : at + width]) for at in range(0, 4 * width, width)]
    return [fixed | x | y for x, y in combinations(parts, 2)]


def levels() -> list[dict[int, list[int]]]:
    """For each round of cutting: mask of fixed bits to the masks that replace it."""
    out, masks = [], [0]
    for width in (16, 8, 4):
        out.append({m: finer(m, width) for m in masks})
        masks = sorted({x for xs in out[-1].values() for x in xs})
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distances(mask: Column | None = None) -> Column:
    """Differing bits between ``fp`` and each reference, on the bits of ``mask``."""
    apart = [F.col("fp").bitwiseXOR(F.lit(p).cast("long")) for p in REFERENCES]
    return F.array(*[F.bit_count(x if mask is None else x.bitwiseAND(mask)).cast("byte") for x in apart])


def _cells(rows: DataFrame, children: dict[int, list[int]]) -> DataFrame:
    """Rows with ``mask``, once for each of its finer masks, and the key of their cell."""
    longs = "array<bigint>"
    table = F.create_map(
        *[x for m, xs in children.items() for x in (F.lit(_signed(m)).cast("long"), F.lit([_signed(x) for x in xs]).cast(longs))]
    )
    finer_rows = rows.withColumn("mask", F.explode(table[F.col("mask")]))
    return finer_rows.withColumn("cell", F.xxhash64("mask", distances(F.col("mask"))))


def _compared(rows: DataFrame) -> DataFrame:
    """Links (``a``, ``b``: no_id, rep, fp) within each cell, as stars around its least row."""
    rep = rows.schema["rep"].dataType.simpleString()
    node = f"struct<no_id:boolean,rep:{rep},fp:bigint>"
    dealt = rows.select("cell", "rep", "fp", distances().alias("table")).repartition("cell").sortWithinPartitions("cell", "fp")

    def pairs(fps: np.ndarray, table: np.ndarray) -> Component:
        found = Component(len(fps))
        for i in range(len(fps) - 1):
            apart = np.abs(table[i + 1 :] - table[i]).max(axis=1)
            near = np.flatnonzero(apart <= REACH) + i + 1
            for j in near[np.bitwise_count(fps[near] ^ fps[i]) <= REACH].tolist():
                found.join(i, j)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def each() -> Iterator[tuple]:
            for batch in batches:
                kinds[:] = [batch.schema.field("rep").type]
                yield from zip(*[batch.column(c).to_pylist() for c in ("cell", "rep", "fp", "table")])

        def nodes(values: list[tuple]) -> pa.StructArray:
            no_id, ids, fps = zip(*values) if values else ((), (), ())
            arrays = [pa.array(no_id, pa.bool_()), pa.array(ids, kinds[0]), pa.array(fps, pa.int64())]
            return pa.StructArray.from_arrays(arrays, ["no_id", "rep", "fp"])

        a, b = [], []
        for _, group in groupby(each(), lambda r: r[0]):
            # two masks of one level may share a cell by a hash collision
            members = list({r[2]: r for r in group}.values())
            found = pairs(np.array([r[2] for r in members], np.int64).view(np.uint64), np.array([r[3] for r in members], np.int8))
            least: dict[int, tuple] = {}
            for i, r in enumerate(members):
                own = (r[1] is None, r[1], r[2])
                first = least.setdefault(found.root(i), own)
                if first is not own:
                    a.append(own)
                    b.append(first)
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([nodes(a), nodes(b)], ["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([nodes(a), nodes(b)], ["a", "b"])

    return dealt.mapInArrow(run, f"a {node}, b {node}")


def links(own: DataFrame) -> DataFrame:
    """Links between distinct fingerprints (``fp, rep``), enough for their components."""
    found = None
    rows = own.select("fp", "rep", F.lit(0).cast("long").alias("mask"))
    rounds = levels()
    for at, children in enumerate(rounds):
        last = at == len(rounds) - 1
        cells = stored(_cells(rows, children), "simhash-cells")
        sizes = stored(cells.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "simhash-sizes")
        met = cells.join(sizes, "cell")
        # 8 open bits are left after the last round, so its cells are small
        linked = stored(_compared(met if last else met.where(F.col("m") <= TILE)).distinct(), "simhash-links")
        found = linked if found is None else found.unionByName(linked)
        if last or sizes.where(F.col("m") > TILE).isEmpty():
            return found.distinct()
        rows = stored(met.where(F.col("m") > TILE).select("fp", "rep", "mask"), "simhash-large")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every document."""
    every = stored(fingerprints(docs), "simhash-fingerprints")
    own = stored(every.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    found = components(links(own)).select(F.col("node.fp").alias("fp"), F.col("top.rep").alias("top"))
    named = own.join(found, "fp", "left").select("fp", F.coalesce("top", "rep").alias("component_id"))
    return every.join(stored(named, "simhash-components"), "fp", "left").select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return near_duplicates(docs).select("doc_id", digits, "component_id")
