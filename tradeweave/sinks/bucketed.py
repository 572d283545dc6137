"""Incremental keyed loads that leave the stored rows where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.sinks.keys import with_surrogate_key

#: Column the table is bucketed by: a hash of the loaded columns.
ROW = "row_hash"
BUCKETS = 64


def rows_not_in(df: DataFrame, stored: DataFrame) -> DataFrame:
    """The distinct rows of ``df`` a table bucketed by ``ROW`` does not have; nulls equal nulls.

    Only ``df`` is shuffled: the hash is the one join key, so the buckets are
    the partitions of the join.  Rows are the same if all columns agree; that
    test is kept inside one expression, as a plain conjunction would become
    join keys and the buckets would no longer do.
    """
    columns = df.columns
    fresh = df.distinct().withColumn(ROW, F.xxhash64(*columns)).alias("fresh")
    known = stored.select(ROW, *columns).alias("known")

    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.`{name}`")

    same = F.array(*[of("fresh", c).eqNullSafe(of("known", c)) for c in columns])
    found = (of("fresh", ROW) == of("known", ROW)) & F.forall(same, lambda x: x)
    return fresh.join(known.hint("merge"), found, "left_anti").select(*columns)


def append_new_bucketed(
    df: DataFrame, table: str, path: str, key: str = "id", buckets: int = BUCKETS
) -> None:
    """Add the distinct rows the table lacks, numbered on from its largest key.

    The catalog table ``table`` keeps its files at ``path``, in ``buckets``
    buckets by a hash of the row, column ``ROW``.  It is made if there is
    none; files of an earlier session are taken up again.  What is stored is read in place and never
    shuffled: a load moves the rows that come in, and writes one file a bucket.
    An empty frame adds nothing; copies of a row count once; ``df`` may not have columns
    named like the key or ``ROW``.
    """
    spark, columns = df.sparkSession, df.columns
    if {key, ROW} & set(columns):
        raise ValueError(f"{key} and {ROW} are made by the load")

    if not spark.catalog.tableExists(table):
        # by statement: a first save as a table would replace files that are there
        quoted = {c.name: "`" + c.name.replace("`", "``") + "`" for c in df.schema}
        typed = ", ".join(f"{quoted[c.name]} {c.dataType.simpleString()}" for c in df.schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} (`{key}` BIGINT, {typed}, `{ROW}` BIGINT) USING parquet"
            f" CLUSTERED BY (`{ROW}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    stored = spark.table(table)
    last = stored.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).first()["last"]
    numbered = with_surrogate_key(rows_not_in(df, stored), columns, key, last + 1)
    placed = numbered.withColumn(ROW, F.xxhash64(*columns)).repartition(buckets, ROW)
    placed.write.mode("append").bucketBy(buckets, ROW).saveAsTable(table)
