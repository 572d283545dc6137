"""Removal of repeated byte strings of ``LENGTH`` bytes.

Candidates are runs of windows (see ``anchors``). Runs that are equal in all of
their windows are folded to one string with a count; strings that share an
anchor but differ meet in one task, which decides exactly which of their
windows repeat: it trims the strings to what some other string of their anchor
shares around it, folds those that are equal now, builds the suffix order and
Burrows-Wheeler transform of the rest and expands intervals breadth first,
extending matches backwards by one byte a round. Round L finds where common
prefixes of length L end; the intervals left at ``LENGTH`` are the repeated
strings. Anchors with more than ``MANY`` different strings are decided window by
window in a shuffle.

Defined results: null and empty texts have no bytes; texts below ``LENGTH``
bytes keep all; repeated rows repeat each other, so all their windows go; a
matched string ends with its document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.anchors import RUNS, candidates, keyed, leftmost_least, merged, packed, run_starts, with_candidates, with_mixed
from tradeweave.llm.common import raw_bytes, sliced, stored
from tradeweave.llm.words import mixed

LENGTH = 400
GRAM = 64
#: Bytes handled at once by one task when anchors are chosen, and when strings are compared (small, for the caches);
#: and when strings are cut from texts or taken out of them.
PIECE, BUCKET, SLICE = 1 << 18, 1 << 17, 2 << 20
MANY = 1_000

_RANDOM = np.random.default_rng(20_240_101)
LETTERS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
FACTORS = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each place on."""
    value, held, step = LETTERS[data], 1, 0
    while held < size:
        value = value[:-held] * FACTORS[step] + value[held:]
        held, step = 2 * held, step + 1
    return mixed(value)


def byte_runs(data: bytes, bounds: list[tuple[int, int]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Start, windows, anchor and digest of the runs of the texts at ``bounds`` in ``data``."""
    if len(data) < length:
        return
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    places = leftmost_least(hashes, length - GRAM + 1)
    valid = np.concatenate([np.arange(a, max(a, b - length + 1)) for a, b in bounds])
    starts, counts = run_starts(places, valid)
    anchors = hashes[places[starts]].view(np.int64)
    view = memoryview(data)
    for start, n, anchor in zip(starts.tolist(), counts.tolist(), anchors.tolist()):
        yield start, n, anchor, xxhash.xxh3_64_intdigest(view[start : start + n + length - 1])


def pieces(texts: list[bytes], length: int, piece: int) -> Iterator[tuple[bytes, list[tuple[int, int]], list[tuple[int, int]]]]:
    """Texts joined to pieces: bytes, bounds in them, and (text, offset in it) of each bound.

    A long text comes in several pieces that overlap by a window.
    """
    held, bounds, names, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), piece):
            part = text[at : at + piece + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > 2 * piece and held:
                yield b"".join(held), bounds, names
                held, bounds, names, size = [], [], [], 0
            bounds.append((size, size + len(part)))
            names.append((i, at))
            held.append(part)
            size += len(part)
    if held:
        yield b"".join(held), bounds, names


def runs(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", PIECE):
            for data, bounds, names in pieces(raw_bytes(batch, "text"), length, PIECE):
                found = list(byte_runs(data, bounds, length))
                if not found:
                    continue
                start, n, anchor, content = zip(*found)
                start = np.array(start)
                which = np.searchsorted([a for a, _ in bounds], start, "right") - 1
                own = pa.array(np.array([i for i, _ in names])[which])
                inside = start - np.array([a for a, _ in bounds])[which] + np.array([at for _, at in names])[which]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(own),
                        pa.array(packed(inside, np.array(n), batch.column("digest").take(own).to_numpy())),
                        pa.array(anchor, pa.int64()),
                        pa.array(np.array(content, np.uint64).view(np.int64)),
                    ],
                    ["doc", "place", "anchor", "content"],
                )

    return rows.select("doc", "digest", "text").mapInArrow(run, RUNS)


#: Symbols of 9 bits that one sort key holds.
PACKED = 7


def first_symbols(text: np.ndarray) -> np.ndarray:
    """The ``PACKED`` symbols from each place on as one number; 0 stands for none after the end."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for at in range(min(PACKED, n)):
        key[: n - at] |= (text[at:].astype(np.int64) + 1) << 9 * (PACKED - 1 - at)
    return key


def changes(ordered: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it, and at the first."""
    return np.concatenate(([True], ordered[1:] != ordered[:-1]))


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``length`` symbols (prefix doubling).

    The first sort is on ``PACKED`` symbols at once, the next ones on three ranks
    at once where they fit one number; only suffixes that still agree with
    another one are sorted again.
    """
    n = len(text)
    ranks = 3 if (n + 2) ** 3 < 1 << 63 else 2
    key = first_symbols(text)
    # suffixes that agree may come in any order
    order = np.argsort(key)
    head = changes(key[order])
    rank = np.zeros(n + 1, np.int64)  # at the end: below all others
    held = PACKED
    while held < length:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            break
        rank[order] = np.cumsum(head)
        rows = order[tied]
        key = rank[rows]
        for at in range(held, ranks * held, held):
            key = key * (n + 2) + rank[np.minimum(rows + at, n)]
        by = np.argsort(key)
        order[tied] = rows[by]
        head[tied] = changes(key[by])
        held *= ranks
    return order


def short_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix shares fewer than ``length`` symbols with the one before it.

    Breadth-first backward extension: an interval of the order is all suffixes
    that start with one string. Extending the string backwards by a symbol maps
    the interval's rows with that symbol to the next interval; where the row
    after its end is still unmarked, the common prefix there is the string's
    length. An interval whose end was marked before is not followed. The first
    strings are those of up to ``PACKED`` symbols, which are compared as numbers.
    """
    n = len(text)
    first = min(PACKED, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = order - 1  # of the first suffix: the last, as on a circle
    last_column = text[before].astype(np.int64)
    back = place[before]
    key = first_symbols(text)[order] >> 9 * (PACKED - first)
    differ = key[1:] ^ key[:-1]
    marked = np.ones(n + 1, bool)
    marked[1:n] = differ > 0
    low, high = np.flatnonzero(marked[:n]), np.flatnonzero(marked[1:])
    # only where the last of the first symbols ends the common prefix
    fresh = np.flatnonzero(differ[high[:-1]] < 1 << 9)
    low, high = low[fresh], high[fresh]
    for _ in range(first, length):
        if not len(low):
            break
        sizes = high - low + 1
        owner = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(len(owner)) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)
        key = owner * 257 + last_column[rows]
        by = np.argsort(key)
        ranked = key[by]
        edge = np.flatnonzero(ranked[1:] != ranked[:-1])
        starts = np.concatenate(([0], edge + 1))
        # the order is exact to ``length`` symbols only, so rows of an interval may map in any order
        mapped = back[rows[by]]
        low, high = np.minimum.reduceat(mapped, starts), np.maximum.reduceat(mapped, starts)
        fresh = ~marked[high + 1]
        low, high = low[fresh], high[fresh]
        marked[high + 1] = True
    return marked[:n]


def repeated_windows(strings: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each string, the starts of its windows that occur twice or more."""
    sizes = np.array([len(s) for s in strings])
    # 0 ends a string; no window reaches over it
    text = np.zeros(int(sizes.sum()) + len(strings), np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    for s, at in zip(strings, starts):
        text[at : at + len(s)] = np.frombuffer(s, np.uint8).astype(np.int64) + 1
    order = suffix_order(text, length)
    group = np.cumsum(short_prefixes(text, order, length)) - 1
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    inside = np.arange(len(text)) - starts[owner]
    whole = inside + length <= sizes[owner]
    weight = np.bincount(group[whole[order]], np.array(counts)[owner[order[whole[order]]]], minlength=int(group[-1]) + 1)
    twice = np.zeros(len(text), bool)
    twice[order] = weight[group] > 1
    twice &= whole
    return [np.flatnonzero(twice[at : at + size]) for at, size in zip(starts, sizes)]


def stretches(windows: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    if not len(windows):
        return []
    if windows[-1] - windows[0] == len(windows) - 1:
        return [(int(windows[0]), int(windows[-1]))]
    cut = np.flatnonzero(np.diff(windows) != 1)
    return list(zip(windows[np.append(0, cut + 1)].tolist(), windows[np.append(cut, len(windows) - 1)].tolist()))


COVERS = "anchor long, content long, low long, high long"


def cut_strings(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``anchor, content, w, bytes`` of the wanted strings (``at``: where one stands)."""
    lists = wanted.groupBy("at.doc", "at.digest").agg(F.collect_list(F.struct("anchor", "content", "w", "at.start", "at.n")).alias("cuts"))
    rows = texts.where("text is not null").join(lists, ["doc", "digest"]).select("text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            out = []
            for text, cuts in zip(raw_bytes(batch, "text"), batch.column("cuts").to_pylist()):
                for c in cuts:
                    part = text[c["start"] : c["start"] + c["n"] + length - 1]
                    # another text may share the row's name
                    if xxhash.xxh3_64_intdigest(part) == c["content"] % (1 << 64):
                        out.append((c["anchor"], c["content"], c["w"], part))
            columns = zip(list(zip(*out)) or [()] * 4, [pa.int64()] * 3 + [pa.binary()])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["anchor", "content", "w", "bytes"])

    return rows.mapInArrow(run, "anchor long, content long, w long, bytes binary")


def anchor_places(strings: list[bytes], anchors: list[int]) -> list[int]:
    """Where the anchor of each string stands in it: the first place with that hash."""
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes)
    hashes = gram_hashes(np.frombuffer(b"".join(strings), np.uint8)).view(np.int64)
    hits = np.flatnonzero(hashes == np.repeat(np.array(anchors, np.int64), sizes)[: len(hashes)])
    return (hits[np.searchsorted(hits, ends - sizes)] - ends + sizes).tolist()


def longest_shared(parts: list[bytes]) -> list[int]:
    """Length of the longest prefix that each part shares with another one."""
    by = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(by, by[1:]):
        size = min(len(parts[i]), len(parts[j]))
        differ = int.from_bytes(parts[i][:size]) ^ int.from_bytes(parts[j][:size])
        shared = size - (differ.bit_length() + 7) // 8
        out[i], out[j] = max(out[i], shared), max(out[j], shared)
    return out


def shared_bounds(strings: list[bytes], counts: list[int], places: list[int]) -> list[tuple[int, int]]:
    """For the strings of one anchor, the bounds of all that another one may repeat.

    Equal windows have the anchor at the same place, so they lie in what the two
    strings share to its left and to its right. A string that stands twice or
    more repeats as a whole.
    """
    left = longest_shared([s[:at][::-1] for s, at in zip(strings, places)])
    right = longest_shared([s[at:] for s, at in zip(strings, places)])
    return [(0, len(s)) if w > 1 else (at - a, at + b) for s, w, at, a, b in zip(strings, counts, places, left, right)]


def gathered(rows: Iterable[tuple]) -> Iterator[list[list[tuple]]]:
    """``anchor, content, w, bytes`` in order of anchor, as lists of the groups of some anchors."""
    held, size = [], 0
    for _, group in groupby(rows, lambda r: r[0]):
        # a string may be cut from several repeated rows; copies of it count once
        held.append(list({r[1]: r for r in group}.values()))
        size += sum(len(r[3]) for r in held[-1])
        if size >= BUCKET:
            yield held
            held, size = [], 0
    if held:
        yield held


def trimmed(rows: Iterable[tuple], length: int) -> Iterator[list[tuple]]:
    """``anchor, content, start, bytes, w`` of what is left of the strings, anchor by anchor."""
    for held in gathered(rows):
        places = iter(anchor_places([r[3] for g in held for r in g], [r[0] for g in held for r in g]))
        for group in held:
            bounds = shared_bounds([r[3] for r in group], [r[2] for r in group], [next(places) for _ in group])
            yield [(r[0], r[1], a, r[3][a:b], r[2]) for r, (a, b) in zip(group, bounds) if b - a >= length]


def covers(strings: DataFrame, length: int) -> DataFrame:
    """Repeated windows of strings that share an anchor, from the interval expansion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("anchor", "content", "w", "bytes")])

        def decide(held: dict) -> pa.RecordBatch:
            found = repeated_windows([k[1] for k in held], [sum(w for _, _, w in v) for v in held.values()], length)
            out = []
            for (anchor, _), same, windows in zip(held, held.values(), found):
                parts = stretches(windows)
                out += [(anchor, content, start + a, start + b) for content, start, _ in same for a, b in parts]
            columns = list(zip(*out)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4)], ["anchor", "content", "low", "high"]
            )

        held, size = {}, 0
        for group in trimmed(rows(), length):
            # several anchors share one transform; their strings cannot share a window
            for anchor, content, start, data, w in group:
                if (anchor, data) not in held:
                    held[anchor, data] = []
                    size += len(data)
                held[anchor, data].append((content, start, w))
            if size >= BUCKET:
                yield decide(held)
                held, size = {}, 0
        if held:
            yield decide(held)

    return strings.repartition("anchor").sortWithinPartitions("anchor", "content").mapInArrow(run, COVERS)


def covers_by_window(strings: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many strings: windows are counted by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, w, data in zip(*[batch.column(c).to_pylist() for c in ("anchor", "content", "w", "bytes")]):
                n, view = len(data) - length + 1, memoryview(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([anchor] * n, pa.int64()),
                        pa.array([content] * n, pa.int64()),
                        pa.array([w] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(view[i : i + length]) for i in range(n)], pa.binary()),
                    ],
                    ["anchor", "content", "w", "low", "window"],
                )

    # a string may be cut from several repeated rows; copies of it count once
    once = strings.dropDuplicates(["anchor", "content"])
    windows = stored(once.mapInArrow(run, "anchor long, content long, w long, low long, window binary"), "suffix-windows")
    twice = stored(windows.groupBy("window").agg(F.sum("w").alias("c")).where("c > 1").select("window"), "suffix-twice")
    return windows.join(twice, "window").select("anchor", "content", "low", F.col("low").alias("high"))


def removed(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Texts with their spans of bytes to remove applied."""
    lists = spans.groupBy("doc", "digest").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    rows = texts.join(lists, ["doc", "digest"], "left").select("doc_id", "n_bytes", "sha", "text", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            out, kept_bytes = [], []
            for text, sha, spans in zip(raw_bytes(batch, "text"), batch.column("sha").to_pylist(), batch.column("spans").to_pylist()):
                gone = merged([(s["low"], s["high"]) for s in spans or ()])
                if not gone:
                    out.append((0, 0, sha))
                    kept_bytes.append(None)
                    continue
                ends = [0, *[x for span in gone for x in span], len(text)]
                kept = b"".join([text[a:b] for a, b in zip(ends[::2], ends[1::2])])
                kept_bytes.append(kept)
                out.append((sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest()))
            n_removed, n_spans, shas = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(kept_bytes, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def shortened(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``text, row``: texts without their spans; parts of characters at an edge go too."""
    lists = spans.groupBy("doc", "digest").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    rows = texts.join(lists, ["doc", "digest"], "left").select("text", "row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            out = []
            for text, spans in zip(raw_bytes(batch, "text"), batch.column("spans").to_pylist()):
                gone = merged([(s["low"], s["high"]) for s in spans or ()])
                ends = [0, *[x for span in gone for x in span], len(text)]
                out.append(b"".join([text[a:b] for a, b in zip(ends[::2], ends[1::2])]).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("row")], ["text", "row"])

    return rows.mapInArrow(run, T.StructType([T.StructField("text", T.StringType()), rows.schema["row"]]))


def repeated_spans(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``doc, digest, low, high``: bytes covered by strings that repeat."""
    strings = found.groupBy("anchor", "content").agg(F.count("*").alias("w"), F.min(F.struct("doc", "digest", "start", "n")).alias("at"))
    strings = stored(with_mixed(stored(strings, "suffix-distinct"), "suffix"), "suffix-strings")
    mixed = strings.where("mixed")
    many = stored(mixed.groupBy("anchor").count().where(F.col("count") > MANY).select("anchor"), "suffix-many")
    cut = stored(cut_strings(texts, mixed, length), "suffix-bytes")
    equal = strings.where("not mixed and w > 1").select("anchor", "content", F.lit(0).cast("long").alias("low"), (F.col("at.n") - 1).alias("high"))
    decided = (
        equal.unionByName(covers(cut.join(many, "anchor", "left_anti"), length))
        .unionByName(covers_by_window(cut.join(many, "anchor", "left_semi"), length))
    )
    partly = found.select("doc", "digest", "start", "anchor", "content").join(stored(decided, "suffix-covers"), ["anchor", "content"])
    return partly.select("doc", "digest", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + length).alias("high"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept`` (null: nothing was removed)."""
    rows = keyed(docs)
    found = candidates(runs(rows, length), "suffix")
    measured = rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "sha": F.sha2("text", 256)})
    texts = with_candidates(measured, found, ("n_bytes", "sha"), "suffix")
    return removed(texts, repeated_spans(found, texts, length))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings taken out of the texts; a column ``n_chars`` follows them."""
    rows = keyed(docs, carry=True)
    found = candidates(runs(rows, length), "suffix")
    texts = with_candidates(rows, found, (), "suffix", carry=True)
    short = shortened(texts, repeated_spans(found, texts, length))
    text = F.when(~F.col("row.no_text"), F.col("text"))
    columns = {c: F.col(f"row.other.`{c}`") for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.char_length(text).cast(docs.schema["n_chars"].dataType), columns["n_chars"])
    return short.select(*[columns[c].alias(c) for c in docs.columns])
