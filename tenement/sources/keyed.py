"""A keyed table in hash buckets: a batch rewrites the buckets that it touches and nothing else, and is taken once however often it runs."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import children, read_small, removed, write_small


class KeyedTable:
    """Parquet folders ``data/<version>/bucket=<b>``; ``versions/<version>`` names, for every bucket that has rows, the version that wrote it, and the batch (``token``) that made the version.

    A version counts once its manifest is there, written last and in one rename, so a batch that dies leaves nothing behind but a folder that its next run writes again. One writer at a
    time. ``by`` are columns of the key that part the table further, as days do: a batch of one day touches the buckets of that day only. A manifest has one entry per bucket, so
    ``buckets`` bounds it (times the values of ``by``); the table should have as many as make a bucket a file of some 100 MB.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], buckets: int = 64, by: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.key, self.by = spark, path, schema, list(key), list(by)
        newest = self.newest()
        #: A table keeps the number of buckets that it began with.
        self.buckets = self.manifest(newest)["buckets"] if newest >= 0 else buckets

    def bucket(self) -> Column:
        """The name of a row's bucket; values of ``by`` that differ in signs only may share one."""
        number = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string")
        return F.concat_ws("-", *[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("none")), "[^0-9A-Za-z.]", "_") for c in self.by], number)

    def versions(self) -> list[int]:
        return sorted(int(v) for v in children(self.spark, f"{self.path}/versions") if v.isdigit())

    def newest(self) -> int:
        return max(self.versions(), default=-1)

    def manifest(self, version: int) -> dict:
        if version < 0:
            return {"token": None, "buckets": self.buckets, "held": {}}
        return json.loads(read_small(self.spark, f"{self.path}/versions/{version}"))

    def read(self, version: int | None = None, only: Sequence[str] | None = None) -> DataFrame:
        """The table, or some of its buckets, as of a version (the newest); empty before the first."""
        held = self.manifest(self.newest() if version is None else version)["held"]
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(held.items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def merge(self, token: str, items: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame], keep: int = 2) -> int:
        """``fold`` the items into the buckets that hold their keys; the version that has them.

        ``fold`` takes the present rows of those buckets and the items and gives all new rows of the buckets. A token that made the newest version does nothing. ``keep`` versions stay readable; what
        only older ones need is deleted. The names of touched buckets, at most ``buckets`` (times the values of ``by`` in the batch), come to the driver.
        """
        versions = self.versions()
        old = self.manifest(versions[-1] if versions else -1)
        if old["token"] == token:
            return versions[-1]
        touched = sorted(r.bucket for r in items.select(self.bucket().alias("bucket")).distinct().collect())
        version = versions[-1] + 1 if versions else 0
        held = dict(old["held"])
        if touched:
            base = self.read(versions[-1] if versions else -1, touched)
            made = fold(base, items).withColumn("bucket", self.bucket())
            made.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{version}")
            held |= {b: version for b in touched}
        write_small(self.spark, f"{self.path}/versions/{version}", json.dumps({"token": token, "buckets": self.buckets, "held": held}))
        self._drop([v for v in [*versions, version]][:-keep])
        return version

    def _drop(self, versions: Sequence[int]) -> None:
        """Delete versions, first what only they hold, then their manifests, so that a stop in between is mended by the next call."""
        for v in versions:
            later = [x for x in self.versions() if x > v]
            wanted = {(x, b) for y in later for b, x in self.manifest(y)["held"].items()}
            for b, x in self.manifest(v)["held"].items():
                if (x, b) not in wanted:
                    removed(self.spark, f"{self.path}/data/{x}/bucket={b}")
            removed(self.spark, f"{self.path}/versions/{v}")
