"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.workspace import new_path

#: Bytes of text that a task handles at once; one text may be longer.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts of a batch as UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Cuts lineage at replicated files, so that a lost executor costs no more
    than the tasks it ran.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_column: str, text_column: str) -> list:
    """Two columns that name a row: its id and a digest of its text.

    Rows that agree in both are repeated rows: they get equal results, and
    each counts as a document of its own.
    """
    return [F.col(id_column).alias("doc"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("digest")]
