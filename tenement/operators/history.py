"""Sequence operators over daily status history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPENED, NOT_FOUND, DEAL = 0, 1, 2


def latest_snapshot(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Latest row per key, as one aggregation."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def last_run(hist: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of the newest stretch whose days differ by exactly one."""
    w = Window.partitionBy(key).orderBy(F.desc(day))
    gap = F.coalesce((F.datediff(F.lag(day).over(w), day) != 1).cast("int"), F.lit(0))
    marked = hist.withColumn("_gap", gap).withColumn("_gaps", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.where("_gaps = 0").drop("_gap", "_gaps")


def infer_deal(hist: DataFrame, key: str, day: str, status: str) -> DataFrame:
    """key, deal_status, deal_day, n_day_deal from the newest run.

    The deal day is the newest DEAL whose next older row is another status (or that is the only row); the listing opened one row
    after the DEAL before it, or at the run's start.
    """
    w = Window.partitionBy(key).orderBy(F.desc(day))
    run = last_run(hist, key, day).withColumn("_i", F.row_number().over(w)).withColumn("_older", F.lead(status).over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    is_tail = (F.col(status) == DEAL) & ((F.col("_older") != DEAL) | (F.col("_n") == 1))
    run = run.withColumn("_tail", F.min(F.when(is_tail, F.col("_i"))).over(Window.partitionBy(key)))
    run = run.withColumn("_before", F.min(F.when((F.col(status) == DEAL) & (F.col("_i") > F.col("_tail")), F.col("_i"))).over(Window.partitionBy(key)))
    newest = F.min_by(status, "_i")
    out = run.groupBy(key).agg(newest.alias("_newest"), F.max("_tail").alias("_tail"), F.max(F.when(F.col("_i") == F.col("_tail"), F.col(day))).alias("deal_day"),
                               F.coalesce(F.max("_before") - 1, F.max("_n")).alias("_head"))
    return out.select(key, F.when(F.col("_tail").isNotNull(), DEAL).otherwise(F.col("_newest")).alias("deal_status"), "deal_day",
                      F.when(F.col("_tail").isNotNull(), F.col("_head") - F.col("_tail") + 1).cast("long").alias("n_day_deal"))


def transitions(hist: DataFrame, key: str, day: str, status: str) -> DataFrame:
    """Rows whose status differs from the row before."""
    before = F.lag(status).over(Window.partitionBy(key).orderBy(day))
    return hist.withColumn("previous", before).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(status)))
