"""Dimensions that grow and never renumber: ids by a stored table of truths, codes of names by a stored assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.keyed import KeyedTable


def id_table(spark, path: str, buckets: int = 64) -> KeyedTable:
    """A stored table of truth, id and the batch that made the id."""
    return KeyedTable(spark, path, "truth string, id string, since string", ["truth"], buckets)


def get_or_create(table: KeyedTable, truths: DataFrame, truth: str, token: str) -> int:
    """Give every truth that has no id yet one, in one batch; the version of the table that has them.

    Known ones are left out by an anti-join with the buckets that the batch touches, before anything is written. An id is drawn once, as a stored random one: a batch that runs again adds
    nothing, one that died before its manifest left none behind. Nulls have no id.
    """
    new = truths.select(F.col(truth).cast("string").alias("truth")).where("truth is not null").distinct()
    new = new.join(table.read().select("truth"), "truth", "left_anti").persist()
    try:
        return table.merge(token, new, lambda base, add: base.unionByName(add.join(base.select("truth"), "truth", "left_anti").select("truth", F.uuid().alias("id"), F.lit(token).alias("since"))))
    finally:
        new.unpersist()


def with_ids(df: DataFrame, table: KeyedTable, truth: str, out: str) -> DataFrame:
    """df with the id of its truth in place of the truth."""
    ids = table.read().select(F.col("truth").alias("_truth"), F.col("id").alias(out))
    return df.join(ids, F.col(truth).cast("string") == F.col("_truth"), "left").drop("_truth", truth)


def extended_codes(stored: DataFrame, names: DataFrame, step: int = 100) -> DataFrame:
    """parent, name, code: the stored assignment and, behind the last code of each parent, the names that are new, in their order.

    A name keeps its code whatever names come later; a parent's codes run from parent x ``step`` on, and one that has no more room fails the job. Names of one parent are numbered in one task: a
    dimension of some thousand names.
    """
    new = names.select("parent", "name").where("parent is not null and name is not null").distinct().join(stored, ["parent", "name"], "left_anti")
    last = stored.groupBy("parent").agg(F.max("code").alias("_last"))
    first = F.coalesce(F.col("_last") + 1, F.col("parent") * step)
    made = new.join(F.broadcast(last), "parent", "left").withColumn("code", (first + F.row_number().over(Window.partitionBy("parent").orderBy("name")) - 1).cast("long"))
    full = F.raise_error(F.concat(F.lit("no code left for "), F.col("name")))
    return stored.select("parent", "name", F.col("code").cast("long").alias("code")).unionByName(made.select("parent", "name", F.when(F.col("code") < (F.col("parent") + 1) * step, F.col("code")).otherwise(full.cast("long")).alias("code")))


def spellings(codes: DataFrame, swaps: dict[str, str], *names: str) -> DataFrame:
    """codes, once per spelling: every column of ``names`` as it stands and with the signs of ``swaps`` replaced, each on its own, so that all combinations lead to one code."""
    for c in names:
        other = F.translate(c, "".join(swaps), "".join(swaps.values()))
        codes = codes.withColumn(c, F.explode(F.array_distinct(F.array(F.col(c), other))))
    return codes
