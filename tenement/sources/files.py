"""Scans and sinks of the published files."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares (spark.checkpoint.dir); a temporary one on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base or tempfile.mkdtemp(prefix='spark-')}/{name}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    """Path and file system of the cluster's own libraries."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, fs = _place(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def removed(spark: SparkSession, path: str) -> None:
    target, fs = _place(spark, path)
    fs.delete(target, True)


def moved(spark: SparkSession, path: str, to: str) -> None:
    target, fs = _place(spark, path)
    if not fs.rename(target, _place(spark, to)[0]):
        raise OSError(f"cannot rename {path} to {to}")


def read_small(spark: SparkSession, path: str) -> str:
    """A file of some KB, such as a manifest, on the driver."""
    target, fs = _place(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside and renamed, over one of that name."""
    target, fs = _place(spark, path)
    beside, _ = _place(spark, f"{path}.new")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"cannot rename to {path}")


def read_csvs(spark: SparkSession, glob: str, schema: StructType | str) -> DataFrame:
    """Many monthly files as one table; ``-`` is null."""
    return spark.read.schema(schema).csv(glob, header=True, nullValue="-")


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """One header per file, null as ``-``. ``order`` sorts the whole export by range."""
    (df.orderBy(*order) if order else df).write.csv(path, header=True, nullValue="-", emptyValue="-", escape='"')


def write_json_by(df: DataFrame, path: str, region: str) -> None:
    """JSON lines with all keys in order, nulls too; one folder ``filed_by=<region>`` per region, ``default`` for rows without one. The region stays in the objects."""
    filed = F.coalesce(F.col(region).cast("string"), F.lit("default")).alias("filed_by")
    df.select(*sorted(df.columns), filed).write.option("ignoreNullFields", False).partitionBy("filed_by").json(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """kind, name, code of a JSON document that maps each kind to pairs of name and code."""
    doc = spark.read.schema("value string").text(path, wholetext=True)
    kinds = F.from_json("value", "map<string,array<array<string>>>")
    pairs = doc.select(F.explode(kinds).alias("kind", "pairs")).select("kind", F.explode("pairs").alias("p"))
    return pairs.select("kind", F.get("p", 0).alias("name"), F.get("p", 1).try_cast("int").alias("code"))


def landed(df: DataFrame, raw: str) -> DataFrame:
    """Rows of a landing table that hold raw text, to be read again."""
    return df.where(F.col(raw).isNotNull())


def release_files(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, rows of a release, without its header lines."""
    lines = spark.read.text(path).select("value", "_metadata.file_name", "_metadata.file_size")
    return lines.groupBy(F.col("file_name").alias("file"), F.col("file_size").alias("bytes")).agg((F.count(F.lit(1)) - 1).alias("rows"))
