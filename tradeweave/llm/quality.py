"""Quality rules with risk-controlled thresholds.

Every document gets a handful of measures of its whole text. For each stratum
(a language) and each rule (a measure that is high in junk), labelled held-out
documents select the cutoff: candidates run from lenient to strict, and a
candidate counts as safe if the exact (Clopper-Pearson) upper bound on the
share of good documents it would reject stays within the rule's share of
``RISK``. Testing stops at the first candidate that is not safe, which keeps
the error over the candidates of one rule (fixed-sequence testing); over rules
and strata it is divided (Bonferroni). A stratum without enough labels rejects
nothing beyond the base rule.

Defined results: null and empty texts have no words and fail the base rule;
a null stratum is a stratum of its own; labels that are null or name no
document are unused; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import raw_bytes, sliced, stored

SYMBOLS = b"#*$%&|<>"
#: Base measures, then what the rules need besides.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks", "n_lines")
#: Share of good documents of a stratum that all rules together may reject,
#: and the probability that a stratum's share is above it.
RISK, MISS = 0.05, 0.05
#: Candidate cutoffs of a rule: multiples of 1/GRID.
GRID = 200
#: Strata whose cutoffs are broadcast; beyond it the join shuffles.
BROADCAST_STRATA = 10_000

MARKS = b"!?.,;:"
UPPER = bytes(range(ord("A"), ord("Z") + 1))


def rules(at: str = "") -> dict[str, Column]:
    """Measures in [0, 1], high in junk."""
    chars = F.greatest(F.col(at + "word_chars"), F.lit(1))
    words = F.greatest(F.col(at + "n_words"), F.lit(1))
    shares = {
        "symbols": F.col(at + "n_symbols") / chars,
        "marks": F.col(at + "n_marks") / chars,
        "upper": F.col(at + "n_upper") / chars,
        "repeats": F.col(at + "n_repeat_words") / words,
        "dup_lines": F.col(at + "n_dup_lines") / F.greatest(F.col(at + "n_lines"), F.lit(1)),
    }
    return {k: F.least(v, F.lit(1.0)) for k, v in shares.items()}


def repeat_words(words: list[bytes]) -> int:
    """Words inside a window of three that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    size = len(names)
    pairs = ids[:-2] * size + ids[1:-1]
    if size >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    cover[:-2] |= twice
    cover[1:-1] |= twice
    cover[2:] |= twice
    return int(cover.sum())


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line; lines with a word."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines)), len(lines)


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()  # bytes split at ASCII white space only: 20, 09-0D
    joined = b"".join(words)
    chars = len(joined.decode(errors="replace"))
    count = len(joined)
    repeated, lines = dup_lines(text)
    return (
        len(words),
        chars,
        count - len(joined.translate(None, SYMBOLS)),
        repeated,
        repeat_words(words),
        count - len(joined.translate(None, UPPER)),
        count - len(joined.translate(None, MARKS)),
        lines,
    )


def with_measures(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with a struct ``measures`` in place of the text column."""
    names = [*BASE, *EXTRA]
    kept = df.drop("measures")
    others = [f for f in kept.schema if f.name != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_column):
            rows = [measure(x) for x in raw_bytes(batch, text_column)]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in others], pa.StructArray.from_arrays(columns, names)],
                [*[f.name for f in others], "measures"],
            )

    fields = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return kept.mapInArrow(run, T.StructType([*others, T.StructField("measures", fields)]))


def upper_bound(rejected: int, total: int, miss: float) -> float:
    """Exact upper confidence bound on a binomial share (Clopper-Pearson)."""
    if rejected >= total:
        return 1.0
    low, high = rejected / max(total, 1), 1.0
    for _ in range(50):
        mid = (low + high) / 2
        if binomial_cdf(rejected, total, mid) > miss:
            low = mid
        else:
            high = mid
    return high


def binomial_cdf(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` hits out of ``n``."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return float(k >= n)
    i = np.arange(k + 1)
    # log of n over i by running sums: exact enough and without special functions
    logs = np.concatenate(([0.0], np.cumsum(np.log(n - i[:-1]) - np.log(i[:-1] + 1.0)))) if k else np.zeros(1)
    logs = logs + i * np.log(p) + (n - i) * np.log1p(-p)
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def cutoff(histogram: np.ndarray, risk: float, miss: float) -> float | None:
    """The strictest safe cutoff: documents above it are rejected.

    ``histogram`` counts good held-out documents by ``ceil(measure * GRID)``.
    """
    total = int(histogram.sum())
    chosen = None
    for c in range(GRID - 1, -1, -1):
        above = int(histogram[c + 1 :].sum())
        if upper_bound(above, total, miss) > risk:
            break
        chosen = c / GRID
    return chosen


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, miss: float = MISS) -> DataFrame:
    """One row per stratum: ``stratum`` and a map from rule to cutoff.

    ``measured`` has ``doc_id``, ``stratum`` and ``measures``; all labelled
    documents are used, as counts per cell of the grid.
    """
    kinds = list(rules())
    good = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    rows = measured.select("doc_id", "stratum", "measures.*").select(
        "doc_id",
        "stratum",
        F.explode(F.create_map(*[x for k, v in rules().items() for x in (F.lit(k), F.ceil(v * GRID).cast("int"))])).alias("rule", "cell"),
    )
    counts = rows.join(good, "doc_id", "left_semi").groupBy("stratum", "rule", "cell").count()
    strata = stored(counts, "quality-counts")
    tests = max(1, strata.select("stratum").distinct().count()) * len(kinds)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {}
        for rule, part in pdf.groupby("rule"):
            histogram = np.zeros(GRID + 1, np.int64)
            np.add.at(histogram, part["cell"].to_numpy(), part["count"].to_numpy())
            chosen = cutoff(histogram, risk / len(kinds), miss / tests)
            if chosen is not None:
                out[rule] = chosen
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "cutoffs": [out]})

    kind = measured.schema["stratum"].dataType.simpleString()
    return strata.groupBy("stratum").applyInPandas(choose, f"stratum {kind}, cutoffs map<string, double>")


def judged(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    cutoffs = stored(cutoffs.select(F.col("stratum").alias("of"), "cutoffs"), "quality-cutoffs")
    if cutoffs.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    words, repeats = F.col("measures.n_words"), F.col("measures.n_repeat_words")
    base = (words < 50) | (100 * repeats > 50 * words)
    broken = F.lit(False)
    for name, share in rules("measures.").items():
        # cells are compared, not shares: the very test the cutoff was chosen by
        broken |= F.coalesce(F.ceil(share * GRID) > F.round(F.col("cutoffs")[name] * GRID), F.lit(False))
    joined = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return joined.withColumns({"base_failed": base, "kept": ~base & ~broken}).drop("of", "cutoffs")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed`` and ``kept`` of every document."""
    measured = stored(
        with_measures(docs.select("doc_id", "text", F.col("lang").alias("stratum"))), "quality-measures"
    )
    result = judged(measured, thresholds(measured, labels))
    return result.select("doc_id", *[f"measures.{n}" for n in BASE], "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were.

    The text is measured twice, once for the cutoffs and once in passing, so
    that it is never shuffled.
    """
    stratum = F.col("lang").alias("stratum")
    cutoffs = thresholds(with_measures(docs.select("doc_id", "text", stratum)), labels)
    # the row travels as one struct: no column of it can clash with ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", stratum)
    return judged(with_measures(rows), cutoffs).where("kept").select("row.*")
