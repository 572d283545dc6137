"""Toxicity scores by FTRL-proximal logistic regression.

A document is the set of its hashed lower-cased words, word pairs and skip
pairs (one or two words between). FTRL-proximal keeps a learning rate per
coordinate and an L1 penalty that leaves most weights at exactly zero, so the
model is a short list of (slot, weight), at most ``SLOTS`` long, that every
task gets. It is fitted in one task on at most about ``TRAIN_ROWS`` labelled
documents, chosen by hash of their id; scoring covers every whole text.

Defined results: null and empty texts score by the bias alone; of rows that
repeat an id the model learns from one (the least text); labels that are null or name no document are unused; without any label every score is the
prior 0 (bias fitted on nothing gives 0.5, which would call it toxic).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import sliced, strings

#: Slots of the hashed feature space; also the bound on what is broadcast (12 bytes a slot).
SLOTS = 1 << 22
#: Bound of the training sample, in documents (expected; chosen by hash).
TRAIN_ROWS = 16_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 1.0
#: Features of fewer training documents are left out: they only memorise.
LEAST_DOCS = 5
WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Multipliers that tell the kinds of pairs apart; the distance between the words is the index plus one.
PAIRS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
TABLE_ENTRIES = 300_000


class Features:
    """Slots of a text; word hashes are kept in a bounded table."""

    def __init__(self) -> None:
        self.table: dict[str, int] = {}

    def hash(self, word: str) -> int:
        if len(self.table) >= TABLE_ENTRIES:
            self.table.clear()
        value = self.table[word] = xxhash.xxh64_intdigest(word)
        return value

    def slots(self, text: str) -> np.ndarray:
        find, make = self.table.get, self.hash
        words = np.array([find(w) or make(w) for w in WORD.findall(text.lower())], np.uint64)
        found = [words]
        for gap, factor in enumerate(PAIRS, 1):
            if len(words) > gap:
                mixed = words[:-gap] * np.uint64(factor) + words[gap:]
                found.append(mixed ^ (mixed >> np.uint64(29)))
        return (np.concatenate(found) >> np.uint64(7)).astype(np.int64) & (SLOTS - 1)


def fit(rows: Iterator[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights that are not zero; slot ``SLOTS`` is the bias."""
    examples = [(np.append(np.unique(slots), SLOTS).astype(np.int32), y) for slots, y in rows]
    seen = np.zeros(SLOTS + 1, np.int32)
    for at, _ in examples:
        seen[at] += 1
    seen[SLOTS] = LEAST_DOCS
    examples = [(at[seen[at] >= LEAST_DOCS], y) for at, y in examples]
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    penalty = np.full(SLOTS + 1, L1)
    penalty[SLOTS] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        shrunk = np.maximum(np.abs(own) - penalty[at], 0.0)
        return -np.sign(own) * shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for at, y in examples:
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    everywhere = weights(np.arange(SLOTS + 1))
    kept = np.flatnonzero(everywhere)
    return kept, everywhere[kept]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Fit on labels of rows whose crc32 of the id, modulo 5, is not 0."""
    labels = (
        labels.where("doc_id is not null and toxic is not null")
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("y"))
    )
    share = min(1.0, rows / max(1, labels.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # at most about TRAIN_ROWS rows of two numbers: bounded at any size of the input
    chosen = labels.where(place < int(share * (1 << 30)))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # rows that repeat an id would lift the bound
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()

        def examples() -> Iterator[tuple[np.ndarray, int]]:
            for batch in sliced(batches, "text"):
                for text, y in zip(strings(batch, "text"), batch.column("y").to_pylist()):
                    yield features.slots(text), y

        slots, weights = fit(examples())
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(weights, pa.float64())], ["slot", "weight"])

    one = sample.select(place.alias("place"), "doc_id", "text", "y").repartition(1)
    model = one.sortWithinPartitions("place", "doc_id", F.xxhash64("text")).select("text", "y").mapInArrow(run, "slot long, weight double")
    found = model.toPandas()
    return found["slot"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)


def scored(df: DataFrame, model: tuple[np.ndarray, np.ndarray], text_column: str = "text") -> DataFrame:
    """``df`` with ``score`` in place of the text column."""
    kept = df.drop("score")
    others = [f for f in kept.schema if f.name != text_column]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, dense = Features(), np.zeros(SLOTS + 1, np.float32)
        slots, weights = shared.value
        dense[slots] = weights
        bias = float(dense[SLOTS]) if len(slots) else -35.0

        def score(text: str) -> float:
            found = features.slots(text)
            found = np.unique(found[dense[found] != 0])
            return float(1.0 / (1.0 + np.exp(-np.clip(dense[found].sum(dtype=np.float64) + bias, -35, 35))))

        for batch in sliced(batches, text_column):
            scores = [score(x) for x in strings(batch, text_column)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in others], pa.array(scores, pa.float64())], [*[f.name for f in others], "score"]
            )

    return kept.mapInArrow(run, T.StructType([*others, T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    result = scored(docs.select("doc_id", "text"), train(docs, labels))
    return result.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below 0.5, with their columns as they were."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return scored(rows, train(docs, labels)).where("score < 0.5").select("row.*")
