"""Where intermediate and output tables are written.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names.
A local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Paths handed out since each open scope began, innermost last.
_SCOPES: list[list[str]] = []
# Masters whose executors are threads of this process and share its folders.
_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; also makes ``checkpoint()`` usable."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not _ONE_PROCESS.fullmatch(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tradeweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder nobody has used yet; an open ``scope`` owns it."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was written to new paths inside.

    A frame is read when an action runs, so whoever runs the last action on a
    result knows when its intermediates may go: write or collect the result
    inside the scope, to a path of your own or one made before it opened.  Scopes nest; a
    path belongs to the innermost one.  Paths go after an error as well.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system holds it, if it is there."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet once and read it back.

    Used where several later steps need one result: the plan below is run one
    time, lineage ends at replicated files instead of executor memory, and the
    next stage plans with real sizes.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
