"""A hot table of days and its archive of older ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import children, moved, removed


def add_hot(df: DataFrame, ts: str, path: str, rows: int = 5_000_000) -> None:
    """Append to the hot table, parted by day. Large days are split over several tasks and files of at most ``rows``; rows without a time stand under the default day."""
    df.withColumn("day", F.to_date(ts)).hint("rebalance", "day").write.option("maxRecordsPerFile", rows).mode("append").partitionBy("day").parquet(path)


def read_hot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, day date").parquet(path)


def hot_days(spark: SparkSession, path: str) -> list[date]:
    """Days that the hot table holds."""
    names = [n.removeprefix("day=") for n in children(spark, path) if n.startswith("day=")]
    return [date.fromisoformat(n) for n in names if n[:1].isdigit()]


def archive_days(spark: SparkSession, hot: str, schema: str, cutoff: date, path: str, run: str, rows: int = 5_000_000) -> list[date]:
    """Move the days up to ``cutoff`` from the hot table to ``path``, as JSON by year, month, day and run; the days that were moved.

    Other days are not read or written. The archive of a day is written first (over what this run wrote of it before), then the day leaves the hot table in one rename. A run that dies and goes on
    under its name adds nothing twice: a day is either still hot, and written again, or gone. Rows that come for an archived day later are a part of a later run.
    """
    for left in children(spark, hot):
        if left.startswith(f"_gone-{run}-"):
            removed(spark, f"{hot}/{left}")
    days = sorted(d for d in hot_days(spark, hot) if d <= cutoff)
    if not days:
        return []
    old = read_hot(spark, hot, schema).where(F.col("day").between(days[0], days[-1]))
    dated = old.withColumns({"y": F.date_format("day", "yyyy"), "m": F.date_format("day", "MM"), "d": F.date_format("day", "dd"), "run": F.lit(run)}).drop("day")
    dated.hint("rebalance", "y", "m", "d").write.option("maxRecordsPerFile", rows).option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("y", "m", "d", "run").json(path)
    for day in days:
        gone = f"{hot}/_gone-{run}-{day}"
        moved(spark, f"{hot}/day={day}", gone)
        removed(spark, gone)
    return days
