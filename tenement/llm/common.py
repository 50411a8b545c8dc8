"""Shared helpers of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; a temporary one only on a local master, where all workers see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again: several times smaller than a checkpoint of wide rows."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder by the file system it is in."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What operators keep in the shared folder inside the block (checkpoints, tables, models) is deleted at its end, so results must be written
    or collected before. The folder is set for the whole Spark context: one block at a time."""
    outer, sc = shared_dir(spark), spark.sparkContext
    sc.setCheckpointDir(outer)  # a new folder within
    own = sc.getCheckpointDir()
    try:
        yield
    finally:
        sc.setCheckpointDir(outer.rsplit("/", 1)[0])
        removed(spark, own)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of df has them."""
    taken, pad = {c.lower() for c in df.columns}, "_"
    while any(pad + n.lower() in taken for n in names):
        pad += "_"
    return [pad + n for n in names]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, mod: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def workers(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
