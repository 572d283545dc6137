"""Sink contracts: typed coercion, quarantine, rejects with reasons, validated appends.

How a value is cast depends on the pair of its own type and the wanted one.
Nothing is cut: texts stay whole while rows are matched, and what is too long for
the target is told apart when it is written.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.functions.columns import CURRENCY_MARKS, NUMBER

#: Digits kept of a text on its way to a whole number.
EXACT = "decimal(38,10)"


class ContractError(ValueError):
    """A frame's columns do not match the contract of its target."""


def _cast(value: Column, source: T.DataType, kind: str) -> Column:
    """``value`` as ``kind``, null where it cannot be one.

    Text becomes a number as a price does, without a detour through floating
    point; numbers keep their digits; NaN and infinities are no numbers; dates,
    timestamps and booleans come from themselves and from text; what has no
    meaning, a boolean as a price for example, is null.
    """
    target = T._parse_datatype_string(kind)
    if isinstance(target, T.StringType):
        return value.cast(kind)
    if isinstance(target, T.NumericType):
        if isinstance(source, T.StringType):
            bare = F.trim(F.regexp_replace(value, CURRENCY_MARKS, ""))
            exact = bare.try_cast(EXACT).try_cast(kind) if isinstance(target, T.IntegralType) else bare.try_cast(kind)
            return F.when(bare.rlike(NUMBER), exact)
        if isinstance(source, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value.try_cast(kind))
        return value.try_cast(kind) if isinstance(source, T.NumericType) else F.lit(None).cast(kind)
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(source, T.StringType):
        return F.trim(value).try_cast(kind)
    if source == target or isinstance(source, moments) and isinstance(target, moments):
        return value.try_cast(kind)
    return F.lit(None).cast(kind)


@dataclass(frozen=True)
class Contract:
    """Column -> Spark type, with length limits for text and defaults for gaps."""

    types: Mapping[str, str]
    lengths: Mapping[str, int] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)

    def coerced(self, df: DataFrame, column: str) -> Column:
        """The column as the contract wants it; null if it cannot be cast."""
        return _cast(df[column], df.schema[column].dataType, self.types[column])

    def too_long(self, df: DataFrame, column: str) -> Column:
        """True for text beyond the length the target has for it."""
        if column not in self.lengths:
            return F.lit(False)
        return F.coalesce(F.length(df[column].cast("string")) > self.lengths[column], F.lit(False))


# The mediated product table every matched product is loaded into.
MEDIATED = Contract(
    types={
        "name": "string",
        "category": "string",
        "ratings": "double",
        "discount_price": "decimal(10,2)",
        "actual_price": "decimal(10,2)",
        "source": "string",
    },
    lengths={"name": 500, "category": 100, "source": 50},
    defaults={"category": "", "ratings": 0.0},
)


def check_contract(df: DataFrame, contract: Contract) -> None:
    """Raise unless the frame has exactly the contract's columns."""
    missing = [c for c in contract.types if c not in df.columns]
    unknown = [c for c in df.columns if c not in contract.types]
    if missing:
        raise ContractError(f"missing required columns: {', '.join(missing)}")
    if unknown:
        raise ContractError(f"unknown columns: {', '.join(unknown)}")


def _unfit(df: DataFrame, contract: Contract, column: str) -> Column:
    """True for a value that is present but not castable, or missing where the
    contract has no default; missing text is a null like any other."""
    if contract.types[column] == "string":
        return F.lit(False)
    required = F.lit(column not in contract.defaults)
    return contract.coerced(df, column).isNull() & (df[column].isNotNull() | required)


def _any(columns: list[Column]) -> Column:
    return reduce(or_, columns, F.lit(False))


def coerce_to_contract(df: DataFrame, contract: Contract = MEDIATED) -> DataFrame:
    """Cast every column and fill defaults; texts stay whole."""
    check_contract(df, contract)
    return df.select(
        *[
            (
                F.coalesce(contract.coerced(df, c), F.lit(contract.defaults[c]).cast(kind))
                if c in contract.defaults
                else contract.coerced(df, c)
            ).alias(c)
            for c, kind in contract.types.items()
        ]
    )


def quarantine(df: DataFrame, contract: Contract = MEDIATED) -> tuple[DataFrame, DataFrame]:
    """(coerced good rows, rejected rows as they came in).

    Rows are rejected for values that cannot be cast or are missing.  Texts that
    are too long for the target are still good for matching; see ``split_fitting``.
    """
    check_contract(df, contract)
    bad = _any([_unfit(df, contract, c) for c in contract.types])
    return coerce_to_contract(df.where(~bad), contract), df.where(bad)


def split_fitting(df: DataFrame, contract: Contract = MEDIATED) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the target, rows with a text that is too long), both whole."""
    long = _any([contract.too_long(df, c) for c in contract.lengths])
    return df.where(~long), df.where(long)


def rejects_report(df: DataFrame, contract: Contract = MEDIATED) -> DataFrame:
    """The rows a load does not take, as they came in, with ``problems``: an array of
    (column, reason) that names every fault of a row.

    Reasons are ``missing``, ``not a <type>`` and ``longer than <n>``.
    """
    check_contract(df, contract)
    found = []
    for column, kind in contract.types.items():
        reason = (
            F.when(_unfit(df, contract, column) & df[column].isNull(), F.lit("missing"))
            .when(_unfit(df, contract, column), F.lit(f"not a {kind}"))
            .when(contract.too_long(df, column), F.lit(f"longer than {contract.lengths.get(column)}"))
        )
        found.append(F.when(reason.isNotNull(), F.struct(F.lit(column).alias("column"), reason.alias("reason"))))
    return df.withColumn("problems", F.array_compact(F.array(*found))).where(F.size("problems") > 0)


def append_validated(df: DataFrame, path: str, contract: Contract = MEDIATED) -> DataFrame:
    """Append only if the columns fit the contract exactly; returns the rows that
    are too long for the target, which are not written."""
    check_contract(df, contract)
    fitting, long = split_fitting(df, contract)
    coerce_to_contract(fitting, contract).write.mode("append").parquet(path)
    return long
