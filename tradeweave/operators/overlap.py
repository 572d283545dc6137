"""Influencer overlap: profiles against sales partnerships by a shared key.

A null key matches nothing.  Document stores match a null or missing key with a
null or missing key; ``null_safe=True`` does the same.

Inner and anti joins are left to Spark: the anti joins only need the other
side's distinct keys, and AQE splits the partitions of a frequent key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.workspace import materialize

#: Chunks the matches of one key are dealt to.
CHUNKS = 64


def _same(left: DataFrame, right: DataFrame, key: str, null_safe: bool) -> Column:
    return left[key].eqNullSafe(right[key]) if null_safe else left[key] == right[key]


def common_rows(
    profiles: DataFrame, sales: DataFrame, key: str = "email", null_safe: bool = False
) -> DataFrame:
    """One row per (profile, partnership) with the same key; the key once, and
    a column both sides have is taken from the profile."""
    extra = [c for c in sales.columns if c not in profiles.columns]
    joined = profiles.join(sales, _same(profiles, sales, key, null_safe))
    return joined.select(*[profiles[c] for c in profiles.columns], *[sales[c] for c in extra])


def exclusive_rows(
    left: DataFrame, right: DataFrame, key: str = "email", null_safe: bool = False
) -> DataFrame:
    """The left rows whose key the right side does not have."""
    keys = right.select(key).distinct()
    return left.join(keys, _same(left, keys, key, null_safe), "left_anti")


def overlap_split(
    profiles: DataFrame, sales: DataFrame, key: str = "email", null_safe: bool = False
) -> dict[str, DataFrame]:
    """The three parts: common, only in profiles, only in partnerships.

    Each side is read and marked once with whether the other side has its key;
    the parts are taken from the marked rows, which are written first.
    """

    def marked(df: DataFrame, other: DataFrame, label: str) -> DataFrame:
        keys = other.select(F.col(key).alias("__key")).distinct().withColumn("__shared", F.lit(True))
        same = df[key].eqNullSafe(keys["__key"]) if null_safe else df[key] == keys["__key"]
        joined = df.join(keys, same, "left").withColumn("__shared", F.col("__shared").isNotNull())
        return materialize(joined.drop("__key"), label)

    left = marked(profiles, sales, "overlap-profiles")
    right = marked(sales, profiles, "overlap-sales")

    def part(df: DataFrame, shared: bool) -> DataFrame:
        return df.where(F.col("__shared") == shared).drop("__shared")

    return {
        "common": common_rows(part(left, True), part(right, True), key, null_safe),
        "only_profiles": part(left, False),
        "only_sales": part(right, False),
    }


def lookup_nested(
    left: DataFrame,
    right: DataFrame,
    key: str = "email",
    name: str = "matched",
    null_safe: bool = False,
    chunks: int = CHUNKS,
    deal: Column | None = None,
) -> DataFrame:
    """Left rows with their matching right rows nested as an array.

    The result has one row for each left row and chunk that holds matches of
    it; a left row without a match has one row, chunk 0, with an empty array.
    Matches are dealt to ``chunks`` chunks by ``deal``, a whole number made from
    the right row (a hash of all of it if none is given), copies of a row to
    consecutive chunks, whatever their number: give more chunks where a key may
    have more matches than that many arrays should hold.

    Copies are counted first, with partial aggregation, and arrays are collected
    by key and chunk, so a frequent key is spread over ``chunks`` groups.
    """
    if not null_safe:
        right = right.where(F.col(key).isNotNull())
    copies = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("__n"))
    steps = F.sequence(F.lit(0), F.least(F.col("__n"), F.lit(chunks)).cast("int") - 1)
    # reduced before the step is added: the sum of two longs may not fit one
    first = F.pmod(F.xxhash64(*right.columns) if deal is None else deal, F.lit(chunks))
    dealt = copies.withColumn("__step", F.explode(steps)).select(
        F.col(key).alias("__key"),
        F.pmod(first + F.col("__step"), F.lit(chunks)).cast("int").alias("chunk"),
        F.array_repeat(
            F.struct(*right.columns), F.ceil((F.col("__n") - F.col("__step")) / chunks).cast("int")
        ).alias("__rows"),
    )
    arrays = dealt.groupBy("__key", "chunk").agg(F.flatten(F.collect_list("__rows")).alias(name))
    same = (
        left[key].eqNullSafe(arrays["__key"]) if null_safe else left[key] == arrays["__key"]
    )
    return left.join(arrays, same, "left").select(
        *[left[c] for c in left.columns],
        F.coalesce("chunk", F.lit(0)).alias("chunk"),
        F.coalesce(name, F.array().cast(arrays.schema[name].dataType)).alias(name),
    )


def top_rows_report(winners: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(type, data) with one whole row as JSON per entry, null for an empty frame.

    ``winners`` maps a type to (frame, numeric column to maximise, tie column);
    the smallest tie value wins.  All entries over one frame share a scan, and
    each task hands on a single row per entry.
    """
    frames = {id(df): df for df, _, _ in winners.values()}
    reports = []
    for key, df in frames.items():
        best = {
            kind: F.min_by(
                F.struct(*df.columns),
                F.struct(F.col(column).isNull(), -F.col(column), F.col(tie)),
            )
            for kind, (frame, column, tie) in winners.items()
            if id(frame) == key
        }
        found = df.agg(*[row.alias(kind) for kind, row in best.items()])
        entries = [
            F.struct(F.lit(kind).alias("type"), F.to_json(F.col(f"`{kind}`")).alias("data"))
            for kind in best
        ]
        reports.append(found.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.union, reports)
