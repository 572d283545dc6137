"""Removal of repeated word windows by recompression.

Documents are sequences of named words. A recompression round names pairs: a
bit of its name puts each symbol into one of two classes, and a symbol of the
first class merges with a following one of the second; the pair's name is a
hash of its parts. Names depend on content alone, so equal substrings get equal
symbols in their interior everywhere, without a shuffle to hand out numbers.
Equal neighbours are in one class and never merge, so runs need no rounds of
their own, and a run that a window cuts keeps its symbols.

After ``ROUNDS`` rounds whether a symbol ends at a gap depends on four words
before it and four after it, and a symbol spans at most eight words; every window of ``WINDOW``
words thus has such gaps inside. The symbol around the gap with the least name
is the window's anchor (see ``anchors``). Symbols that occur once rule out their
windows; shared ones reveal repeats, which 128-bit digests of the windows'
words verify, first for whole runs, then, where runs with one symbol differ,
window by window.

Defined results: null and empty texts have no words; texts with fewer words
than a window keep all; rows that agree in id and text are equally early, so
neither repeats the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.anchors import RUNS, candidates, keyed, leftmost_least, merged, packed, run_starts, with_candidates, with_mixed
from tradeweave.llm.common import raw_bytes, sliced, stored
from tradeweave.llm.words import WordHashes, mixed

WINDOW = 20
ROUNDS = 3
#: Words before and after a gap that decide whether symbols end there.
MARGIN = 1 << (ROUNDS - 1)
#: Words handled at once.
PIECE = 500_000
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def recompress(names: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after the rounds, and the word at which each starts."""
    starts = np.arange(len(names))
    for r in range(rounds):
        if len(names) < 2:
            break
        second = mixed(names ^ SALTS[r]) & np.uint64(1) == 1
        pair = ~second[:-1] & second[1:]
        fresh = names.copy()
        fresh[:-1][pair] = mixed(names[:-1][pair] * SALTS[r] + names[1:][pair])
        keep = np.concatenate(([True], ~pair))
        names, starts = fresh[keep], starts[keep]
    return names, starts


def window_anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Gap chosen for each window start, and the name of each gap (0: no symbol ends there)."""
    _, starts = recompress(words)
    name = np.zeros(len(words) + 1, np.uint64)
    gaps = starts[(starts >= MARGIN) & (starts <= len(words) - MARGIN)]
    around = np.zeros(len(gaps), np.uint64)
    for i in range(-MARGIN, MARGIN):
        around = mixed(around * SALTS[1] + words[gaps + i])
    name[gaps] = around | np.uint64(1) << np.uint64(63)
    # gaps from MARGIN to window - MARGIN lie inside; a gap without a symbol's end is never least
    order = np.where(name == 0, ~np.uint64(0), mixed(name) >> np.uint64(1))
    return leftmost_least(order[MARGIN:], window - 2 * MARGIN + 1) + MARGIN, name


def word_runs(words: np.ndarray, bounds: list[tuple[int, int]], window: int) -> Iterator[tuple[int, int, int, int]]:
    """Start, windows, anchor and digest of the runs of the texts at ``bounds``."""
    if len(words) < window:
        return
    places, name = window_anchors(words, window)
    valid = np.concatenate([np.arange(a, max(a, b - window + 1)) for a, b in bounds])
    starts, counts = run_starts(places, valid)
    anchors = name[places[starts]].view(np.int64)
    view = memoryview(words.view(np.uint8))
    for start, n, anchor in zip(starts.tolist(), counts.tolist(), anchors.tolist()):
        yield start, n, anchor, xxhash.xxh3_64_intdigest(view[8 * start : 8 * (start + n + window - 1)])


def runs(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches, "text"):
            held, bounds, names, size = [], [], [], 0

            def found() -> pa.RecordBatch | None:
                out = list(word_runs(np.concatenate(held), bounds, window))  # noqa: B023
                if not out:
                    return None
                start, n, anchor, content = zip(*out)
                start = np.array(start)
                which = np.searchsorted([a for a, _ in bounds], start, "right") - 1  # noqa: B023
                own = pa.array(np.array([i for i, _ in names])[which])  # noqa: B023
                inside = start - np.array([a for a, _ in bounds])[which] + np.array([at for _, at in names])[which]  # noqa: B023
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(own),  # noqa: B023
                        pa.array(packed(inside, np.array(n), batch.column("digest").take(own).to_numpy())),  # noqa: B023
                        pa.array(anchor, pa.int64()),
                        pa.array(np.array(content, np.uint64).view(np.int64)),
                    ],
                    ["doc", "place", "anchor", "content"],
                )

            for i, text in enumerate(raw_bytes(batch, "text")):
                words = hashes.of(text.split())
                # a long text comes in pieces that overlap by a window
                for at in range(0, len(words) - window + 1, PIECE):
                    part = words[at : at + PIECE + window - 1]
                    bounds.append((size, size + len(part)))
                    names.append((i, at))
                    held.append(part)
                    size += len(part)
                    if size >= PIECE:
                        if (made := found()) is not None:
                            yield made
                        held, bounds, names, size = [], [], [], 0
            if held and (made := found()) is not None:
                yield made

    return rows.select("doc", "digest", "text").mapInArrow(run, RUNS)


def single_windows(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``doc, digest, start, content`` of every window of the wanted runs (``at``)."""
    lists = wanted.groupBy("at.doc", "at.digest").agg(F.collect_list(F.struct("at.start", "at.n")).alias("cuts"))
    rows = texts.where("text is not null").join(lists, ["doc", "digest"]).select("doc", "digest", "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches, "text"):
            own, starts, contents = [], [], []
            for i, (text, cuts) in enumerate(zip(raw_bytes(batch, "text"), batch.column("cuts").to_pylist())):
                view = memoryview(hashes.of(text.split()).view(np.uint8))
                for c in cuts:
                    for start in range(c["start"], c["start"] + c["n"]):
                        own.append(i)
                        starts.append(start)
                        contents.append(xxhash.xxh3_128_digest(view[8 * start : 8 * (start + window)]))
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(at), batch.column("digest").take(at), pa.array(starts, pa.int64()), pa.array(contents, pa.binary())],
                ["doc", "digest", "start", "content"],
            )

    return rows.mapInArrow(run, "doc long, digest long, start long, content binary")


def later_spans(found: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``doc, digest, low, high``: words covered by windows that also start earlier."""
    firsts = found.groupBy("anchor", "content").agg(F.min(F.struct("doc", "start", "digest", "n")).alias("at"), F.count("*").alias("c"))
    firsts = stored(with_mixed(stored(firsts, "recompression-distinct"), "recompression"), "recompression-firsts")
    place = F.struct("doc", "start")
    again = found.select("doc", "digest", "start", "n", "anchor", "content").join(firsts.where("c > 1").select("anchor", "content", "at"), ["anchor", "content"])
    whole = again.where(place > F.struct("at.doc", "at.start")).select(
        "doc", "digest", F.col("start").alias("low"), (F.col("start") + F.col("n") - 1 + window).alias("high")
    )
    windows = stored(single_windows(texts, firsts.where("mixed"), window), "recompression-windows")
    earliest = windows.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    earliest = stored(earliest.where("first < last").select("content", "first"), "recompression-earliest")
    partly = windows.join(earliest, "content").where(place > F.col("first"))
    return whole.unionByName(partly.select("doc", "digest", F.col("start").alias("low"), (F.col("start") + window).alias("high")))


def removed(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Texts without the words of their spans; without spans only white space changes."""
    lists = spans.groupBy("doc", "digest").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    rows = texts.join(lists, ["doc", "digest"], "left").select("doc_id", "n_words", "sha", "text", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            out, kept = [], []
            for text, sha, spans in zip(raw_bytes(batch, "text"), batch.column("sha").to_pylist(), batch.column("spans").to_pylist()):
                if not spans:
                    out.append((0, sha))
                    kept.append(None)
                    continue
                words = text.split()
                gone = merged([(s["low"], s["high"]) for s in spans])
                ends = [0, *[x for span in gone for x in span], len(words)]
                rest = b" ".join([w for a, b in zip(ends[::2], ends[1::2]) for w in words[a:b]])
                out.append((sum(b - a for a, b in gone), hashlib.sha256(rest).hexdigest()))
                kept.append(rest)
            n_removed, shas = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array(n_removed, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary")


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of words and the digest of the words joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words = [x.split() for x in raw_bytes(batch, "text")]
            shas = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(w) for w in words], pa.int64()), pa.array(shas, pa.string())], [*batch.schema.names, "n_words", "sha"]
            )

    extra = [T.StructField("n_words", T.LongType()), T.StructField("sha", T.StringType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema, *extra]))


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and ``kept`` (null: nothing was removed)."""
    if window < 2 * MARGIN + 4:
        raise ValueError("a window needs room for a whole symbol")
    rows = keyed(docs)
    found = candidates(runs(rows, window), "recompression")
    texts = with_candidates(counted(rows), found, ("n_words", "sha"), "recompression")
    return removed(texts, later_spans(found, texts, window))
