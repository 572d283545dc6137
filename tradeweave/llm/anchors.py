"""Windows that may repeat, found by an anchor that their own content chooses.

Every window of a sequence has one anchor inside it, chosen by the window's
content alone: the leftmost of the smallest hashes. Equal windows thus have
equal anchors at equal places. Windows in a row with the same anchor occurrence
form a run; a run travels as its anchor and a digest of what it spans, never as
text. An anchor that occurs once in all documents rules out its runs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tradeweave.llm.common import stored

#: Low bits of a packed value that hold the place; sequences are handled in pieces below that.
PLACE_BITS = 26
PLACE = np.uint64((1 << PLACE_BITS) - 1)
NO_ID = -(1 << 63)
#: Low bits of a run's place: number of windows, and part of a digest of the row's text.
COUNT_BITS, DIGEST_BITS = 10, 22


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in each window of ``width`` values."""
    packed = (values & ~PLACE) | np.arange(len(values), dtype=np.uint64)
    size, least = 1, packed
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & PLACE).astype(np.int64)


def run_starts(places: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run; ``valid`` are window numbers in order."""
    if not len(valid):
        return valid, valid
    own = places[valid]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1))))
    return valid[first], np.diff(np.append(first, len(valid)))


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id, doc, digest, text, row``: ``doc`` and ``digest`` name a row.

    Rows that agree in both are repeated rows and get equal results. A row
    without id is named by 62 more bits of its text, below all usual ids; ids
    that are no whole numbers are named, and ordered, by a hash. With ``carry``, ``row`` holds the other columns and whether the text is null.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(F.struct(*others).alias("other"), F.col("text").isNull().alias("no_text")) if carry else F.lit(None).cast("boolean")
    whole = isinstance(docs.schema["doc_id"].dataType, IntegralType)
    own = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    no_id = F.lit(NO_ID) + F.xxhash64(F.lit("no id"), text).bitwiseAND(F.lit((1 << 62) - 1))
    return docs.select(
        "doc_id",
        F.coalesce(own, no_id).alias("doc"),
        F.xxhash64(text).bitwiseAND(F.lit((1 << DIGEST_BITS) - 1)).alias("digest"),
        text.alias("text"),
        row.alias("row"),
    )


RUNS = "doc long, place long, anchor long, content long"


def packed(start: np.ndarray, n: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Start, windows and row digest of runs in one number each: most runs are dropped after one shuffle."""
    return start.astype(np.int64) << 32 | n.astype(np.int64) << DIGEST_BITS | digest.astype(np.int64)


def candidates(runs: DataFrame, label: str) -> DataFrame:
    """``doc, digest, start, n, anchor, content`` of the runs whose anchor occurs again."""
    runs = stored(runs, f"{label}-runs")
    known = stored(runs.groupBy("anchor").count().where("count > 1").select("anchor"), f"{label}-anchors")
    place = F.col("place")
    found = runs.join(known, "anchor").select(
        "doc",
        place.bitwiseAND(F.lit((1 << DIGEST_BITS) - 1)).alias("digest"),
        F.shiftrightunsigned(place, 32).alias("start"),
        F.shiftrightunsigned(place, DIGEST_BITS).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).alias("n"),
        "anchor",
        "content",
    )
    return stored(found, f"{label}-candidates")


def with_mixed(strings: DataFrame, label: str) -> DataFrame:
    """``strings`` (a row for each anchor and content) with ``mixed``: the anchor has other contents."""
    several = stored(strings.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("several")), f"{label}-mixed")
    return strings.join(several, "anchor", "left").withColumn("mixed", F.coalesce("several", F.lit(False))).drop("several")


def with_candidates(rows: DataFrame, found: DataFrame, measures: tuple[str, ...], label: str, carry: bool = False) -> DataFrame:
    """``rows`` with their ``measures``; without ``carry`` the text stays only where candidates are."""
    # candidates grow with the input, so they are not left to be broadcast while they happen to be few
    keys = found.select("doc", "digest").distinct().withColumn("has", F.lit(True)).hint("merge")
    joined = rows.join(keys, ["doc", "digest"], "left")
    kept = F.col("text") if carry else F.when(F.col("has"), F.col("text")).alias("text")
    return stored(joined.select("doc_id", "doc", "digest", *measures, kept, "row"), f"{label}-texts")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out
