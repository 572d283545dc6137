"""Surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.workspace import shared_dir

# monotonically_increasing_id() keeps the row's position in its partition in
# the low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def with_surrogate_key(
    df: DataFrame, order_by: Sequence[str | Column], key: str = "id", start: int = 1
) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the order given.

    ``order_by`` must be a total order: then the range partitioning splits even
    if one leading value holds a large share of the rows, and the numbering is
    repeatable.  The sorted rows are checkpointed so that partition sizes and
    positions describe the same layout whatever is recomputed later; after that
    only one number per partition is needed.  Those numbers are broadcast: they
    are as many as the sort has partitions, whatever the data.
    """
    shared_dir(df.sparkSession)
    laid_out = df.orderBy(*order_by).checkpoint()
    placed = laid_out.withColumns(
        {
            "__part": F.spark_partition_id(),
            "__at": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
        }
    )
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition, so a window over all of them is small.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return placed.join(F.broadcast(offsets), "__part").select(
        (F.col("__before") + F.col("__at") + start).cast("long").alias(key), *df.columns
    )
