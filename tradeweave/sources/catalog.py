"""Catalog metadata: registered sources, their tables, and the fields of documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.workspace import new_path

MADE_HERE = "tradeweave.registered"
SNAPSHOT = "source string, `table` string, ordinal int, `column` string, type string"


def register_source(spark: SparkSession, source: str, tables: Mapping[str, str]) -> None:
    """Make a source's tables visible to SQL as ``source.table``.

    A value that starts with SELECT or WITH becomes a view; any other value is
    a parquet path and becomes an external table.  Only tables and views made
    here are replaced; any other of the same name is an error.
    """
    place = new_path(spark, source)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{source}` LOCATION '{place}'")
    for table, body in tables.items():
        name = f"`{source}`.`{table}`"
        is_view = body.split(None, 1)[0].upper() in ("SELECT", "WITH")
        if spark.catalog.tableExists(name):
            made = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            if MADE_HERE not in made:
                raise ValueError(f"{name} exists and was not registered here")
            kind = spark.catalog.getTable(name).tableType
            spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
        made_here = f"TBLPROPERTIES ('{MADE_HERE}' = 'true')"
        if is_view:
            spark.sql(f"CREATE VIEW {name} {made_here} AS {body}")
        else:
            location = body.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE {name} USING parquet {made_here} LOCATION '{location}'")


def catalog_snapshot(spark: SparkSession, sources: Sequence[str]) -> DataFrame:
    """(source, table, ordinal, column, type) of every table of the given sources.

    Only catalog entries pass through the driver, never data.
    """
    rows = [
        (source, table.name, at, column.name, column.dataType)
        for source in sources
        for table in spark.catalog.listTables(source)
        if not table.isTemporary
        for at, column in enumerate(
            spark.catalog.listColumns(f"`{source}`.`{table.name}`"), start=1
        )
    ]
    return spark.createDataFrame(rows, SNAPSHOT)


def write_catalog_snapshot(snapshot: DataFrame, path: str) -> None:
    """The snapshot as JSON, one folder per source."""
    snapshot.write.mode("overwrite").partitionBy("source").json(path)


def read_catalog_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).json(path).select("source", "table", "ordinal", "column", "type")


def field_profile(docs: DataFrame, document: str | Column) -> DataFrame:
    """Fields found in a column of JSON objects: (field, ordinal, n_docs, presence).

    All documents are read, so a field is found even if it is rare.  ``ordinal``
    is the field's last position in any document (fields missing before it only
    move it forward), ``presence`` the share of documents that have it.
    """
    text = F.col(document) if isinstance(document, str) else document
    found = docs.select(F.posexplode(F.json_object_keys(text)).alias("at", "field"))
    # The total is a count that needs no column of the scan.
    total = docs.agg(F.count(F.lit(1)).alias("total")).scalar()
    return (
        found.groupBy("field")
        .agg(F.max("at").cast("int").alias("ordinal"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("presence", F.col("n_docs") / total)
    )


def discover_fields(docs: DataFrame, document: str | Column) -> DataFrame:
    """(ordinal, field): the field names of a document column, in order of
    appearance by ``ordinal`` and name.  A frame, as documents whose keys are
    data have as many names as documents."""
    return field_profile(docs, document).select("ordinal", "field")
