"""Small results written out once and read back."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

LOCAL_MASTER = re.compile(r"local(\[[^\]]*\])?")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the folder that all executors share.

    That is ``spark.checkpoint.dir``, or else the context's checkpoint folder.
    Without either only a master known to be local may fall back to the
    machine's own temporary folder: elsewhere the executors would each write
    to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not LOCAL_MASTER.fullmatch(spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/arrears/{name}-{uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` and read it back, so that several readers share one run.

    Unlike a cached frame the copy outlives lost executors. It stays until
    someone calls ``discard``: a frame that was returned may still read it.
    """
    return _stored(frame, scratch_path(frame.sparkSession, name))


@contextmanager
def staged(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage`` for the length of a block; the copy goes when it ends."""
    path = scratch_path(frame.sparkSession, name)
    try:
        yield _stored(frame, path)
    finally:
        discard(frame.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is, if it exists."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
