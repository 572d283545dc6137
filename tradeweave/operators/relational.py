"""Query clauses that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import price_to_number


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has; unknown ones are left out."""
    return df.select(*[c for c in wanted if c in df.columns])


def select_mapped(df: DataFrame, mapping: Mapping[str, str], source: str | None = None) -> DataFrame:
    """Columns renamed to another schema, ``{source column: target column}``,
    with an optional constant source tag."""
    tag = [] if source is None else [F.lit(source).alias("source")]
    return df.select(*[F.col(s).alias(t) for s, t in mapping.items()], *tag)


def render_text(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def render_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null or the text ``NULL`` in the given columns."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    text = [F.col(c) != "NULL" for c in names if kinds[c] == "string"]
    return df.dropna("any", subset=names).where(reduce(and_, text, F.lit(True)))


def price_key(column: str) -> Column:
    """Sort key of price text: its number, and 0 where there is none."""
    return F.coalesce(price_to_number(column), F.lit(0.0))


def order_by_price_text(df: DataFrame, column: str, ascending: bool = True, *ties: str) -> DataFrame:
    """Sort by the number inside price text.

    ``ties`` continue the order; without them one frequent price would fill one
    range partition.
    """
    key = price_key(column)
    return df.orderBy(key.asc() if ascending else key.desc(), *ties)


def top_k_federated(
    branches: Sequence[DataFrame], order: Sequence[Column], k_branch: int, k: int
) -> DataFrame:
    """Top ``k_branch`` of every source, then top ``k`` of those.

    Each step plans as TakeOrderedAndProject: every task keeps k rows.
    """
    tops = [b.orderBy(*order).limit(k_branch) for b in branches]
    return reduce(DataFrame.unionByName, tops).orderBy(*order).limit(k)


def union_complete(branches: Sequence[DataFrame]) -> DataFrame:
    """Union by name under the first branch's header, gaps left out.

    A branch lacking one of those columns only has incomplete rows and so
    contributes nothing.
    """
    header = branches[0].columns
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return drop_null_rows(merged.select(*header))


def aggregate(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[tuple[str, str]]
) -> DataFrame:
    """Group and aggregate with generated names.

    ``aggregates`` are (function, column) pairs; the result columns are called
    ``avg_x``, ``sum_x``, ``min_x``, ``max_x`` and ``count_x``, which counts values
    that are not null; ``("count", "*")`` counts rows as ``count``.
    """
    makers = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    columns = [
        F.count(F.lit(1)).alias("count")
        if (fn, column) == ("count", "*")
        else makers[fn](column).alias(f"{fn}_{column}")
        for fn, column in aggregates
    ]
    return df.groupBy(*keys).agg(*columns)


def nest_key(df: DataFrame, keys: Sequence[str], name: str = "_id") -> DataFrame:
    """Grouping columns folded into one nested column."""
    return df.select(
        F.struct(*keys).alias(name), *[c for c in df.columns if c not in keys]
    )


def merge_rows(joined: DataFrame, left: Sequence[str], right: Sequence[str]) -> list[Column]:
    """Select list that merges two joined rows; the right value wins on a shared
    name.  ``joined`` holds them under the aliases ``l`` and ``r``."""
    return [joined[f"l.{c}"] for c in left if c not in right] + [joined[f"r.{c}"] for c in right]
