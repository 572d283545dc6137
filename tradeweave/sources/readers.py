"""Scans, file ingestion and union views over tables that drifted apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeweave.functions import price_to_number
from tradeweave.sinks.keys import with_surrogate_key

ID = "_id"
CORRUPT = "_corrupt_record"


def read_relational(spark: SparkSession, source: str) -> DataFrame:
    """A relational table: a parquet path, or a ``db.table`` of the session catalog."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table in a live database, read as ``partitions`` range queries.

    Spark pushes projection, comparisons, aggregates and limits into the
    database.  Credentials come in through ``properties``.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A collection of JSON documents, one per line.

    The schema is given, not inferred: inference reads the data twice, and one
    sampled document would hide the fields it happens to lack.
    """
    return spark.read.schema(schema).json(path)


def drop_id(df: DataFrame) -> DataFrame:
    """The documents without their store-generated id."""
    return df.drop(ID)


def id_as_string(df: DataFrame) -> DataFrame:
    """The documents with their id as text."""
    return df.withColumn(ID, F.col(ID).cast("string"))


def global_view(tables: Sequence[DataFrame]) -> DataFrame:
    """One view over tables that share a schema."""
    return reduce(DataFrame.unionByName, tables)


def global_view_keyed(
    tables: Sequence[DataFrame],
    columns: Sequence[str],
    order_by: Sequence[str],
    key: str = "primary_key",
) -> DataFrame:
    """The global view cut to ``columns`` and numbered by the total order ``order_by``."""
    return number_rows(global_view(tables), columns, order_by, key)


def combined_view(
    collections: Mapping[str, DataFrame],
    renames: Mapping[str, Mapping[str, str]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """One view over collections whose field names drifted.

    ``renames[collection]`` maps that collection's names to the common ones; a
    field some collection lacks is null there.
    """
    aligned = [
        df.withColumnsRenamed(dict(renames.get(name, {}))).drop(*drop)
        for name, df in collections.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


@dataclass(frozen=True)
class Branch:
    """A table or collection that is kept inside a larger source.

    ``where`` tells its rows; where that is null a row is not in it.
    ``renames`` maps source columns to the names this branch gives them.
    """

    where: Column
    renames: Mapping[str, str] = field(default_factory=dict)


def branch_view(
    source: DataFrame,
    branches: Mapping[str, Branch],
    renames: Mapping[str, Mapping[str, str]] | None = None,
    drop: Sequence[str] = (),
    tag: str = "branch",
) -> DataFrame:
    """One view over branches of one source, read in one pass.

    Equals ``combined_view`` over the branches taken one by one, with the name
    of the branch in column ``tag``: a row that lies in several is there once for each,
    a row in none is left out, ``renames[branch]`` brings drifted names back, and a
    column some branch lacks is null there.  Each row is tagged with its
    branches, so the source is scanned once however many there are, and a
    column that is not asked for is not read.
    """
    renames = renames or {}
    named = {
        name: {
            renames.get(name, {}).get(own, own): column
            for column, own in ((c, branch.renames.get(c, c)) for c in source.columns)
        }
        for name, branch in branches.items()
    }
    wanted = [c for c in dict.fromkeys(c for names in named.values() for c in names) if c not in drop]
    inside = F.array_compact(F.array(*[F.when(b.where, F.lit(name)) for name, b in branches.items()]))
    tagged = source.withColumn("__branch", F.explode(inside))

    def column(name: str) -> Column:
        origins = {branch: columns.get(name) for branch, columns in named.items()}
        if len(set(origins.values())) == 1:
            return F.col(f"`{next(iter(origins.values()))}`").alias(name)
        found = [
            F.when(F.col("__branch") == branch, F.col(f"`{origin}`"))
            for branch, origin in origins.items()
            if origin is not None
        ]
        return F.coalesce(*found).alias(name)

    return tagged.select(F.col("__branch").alias(tag), *[column(c) for c in wanted])


def number_rows(
    view: DataFrame, columns: Sequence[str], order_by: Sequence[str], key: str = "primary_key"
) -> DataFrame:
    """A view cut to ``columns`` and numbered by the total order ``order_by``."""
    narrow = view.select(*dict.fromkeys([*columns, *order_by]))
    return with_surrogate_key(narrow, order_by, key).select(key, *columns)


def _clean(df: DataFrame, text: Sequence[str], prices: Sequence[str]) -> DataFrame:
    """Trim text, blank to null, price text to numbers."""
    tidy = {c: F.nullif(F.trim(c), F.lit("")) for c in text}
    return df.withColumns({**tidy, **{c: price_to_number(c) for c in prices}})


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    text: Sequence[str] = (),
    prices: Sequence[str] = (),
) -> DataFrame:
    """Read CSV against a fixed schema and clean it.

    Lines that do not fit the schema stay in the result, with the raw line in
    ``_corrupt_record`` when the schema has that column.
    """
    # With pruning, a line is only checked against the columns a query happens to
    # use, and what counts as broken would vary.
    reader = spark.read.option("columnPruning", CORRUPT not in schema.names)
    raw = reader.csv(
        path,
        schema=schema,
        header=True,
        mode="PERMISSIVE",
        quote='"',
        escape='"',
        multiLine=False,
        columnNameOfCorruptRecord=CORRUPT,
    )
    return _clean(raw, text, prices)


def ingest_json(
    spark: SparkSession,
    path: str,
    schema: StructType,
    text: Sequence[str] = (),
    prices: Sequence[str] = (),
) -> DataFrame:
    """Read JSON lines against a fixed schema and clean them, as ``ingest_csv`` does."""
    raw = spark.read.json(
        path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    return _clean(raw, text, prices)
