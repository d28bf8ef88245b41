"""Rows written to the cluster's checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NullType, StructType


def _folder(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names, a temporary one in a session on one machine, or None."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.split("[")[0] == "local":
            return None
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def can_store(spark: SparkSession) -> bool:
    return _folder(spark) is not None


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and without their lineage, in the folder that ``spark.checkpoint.dir`` names.

    Where none is named, a session on one machine takes a temporary folder; on a cluster that would be
    a folder which other machines cannot see, and so is an error.
    """
    if _folder(df.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return df.checkpoint(eager=True)


def give_back(spark: SparkSession) -> None:
    """Let Spark delete the shuffles of frames that nobody holds any more, which it does when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def stored_parts(spark: SparkSession, part: Callable[[int], DataFrame], parts: int) -> DataFrame:
    """The rows of ``part(0)``, ``part(1)`` and so on, made one part after the other and without their lineage.

    Each part is written as files, in columns and compressed, to the folder of :func:`stored`, and its shuffles are given back
    before the next one starts: the disk holds the shuffles of one part, and the rows that are done. The files go at the
    session's end.
    """
    folder = _folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    base = f"{folder}/parts-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)  # a path that isn't there can't be marked
    files.deleteOnExit(path)
    schema = None
    for i in range(parts):
        schema = _written(part(i), f"{base}/{i}")
        give_back(spark)
    known = StructType([f for f in schema.fields if not isinstance(f.dataType, NullType)])
    rows = spark.read.schema(known).parquet(*[f"{base}/{i}" for i in range(parts)])
    return rows.select(*[F.col(f"`{f.name}`") if f in known.fields else F.lit(None).alias(f.name) for f in schema.fields])


def _written(df: DataFrame, path: str) -> StructType:
    """Write the columns that have a type; a column without one holds nothing."""
    plain = df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, NullType)])
    # blocks are held in memory until they are written, one per task
    plain.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return df.schema
