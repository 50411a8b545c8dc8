"""Cumulative-snapshot collapse of logged conversations, then rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Rolling hash of every turn prefix: two 64-bit hashes, folded by XOR with the turn's rank inside."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    body = turns.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order))
    filled = [F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull()]
    body = body.withColumn("a", F.xxhash64(F.lit(1), "n", *filled)).withColumn("b", F.xxhash64(F.lit(2), *filled[::-1], "n"))
    return body.select("conv_id", "n", F.expr("bit_xor(a)").over(so_far).alias("a"), F.expr("bit_xor(b)").over(so_far).alias("b"),
                       F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_turns"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation: conv_id (smallest of equal ones), n_turns, n_copies.

    A conversation that is a proper prefix of another is dropped. Equal conversations count as copies.
    Turns with null or tied ``turn`` are ordered null first, then by role and text; null text differs from empty text;
    rows with null conv_id are no conversation and are left out. Further columns are ignored.
    """
    prefixes = turn_prefixes(turns.where("conv_id is not null"))
    whole = prefixes.where("n = n_turns").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    proper = prefixes.where("n < n_turns").select("n", "a", "b").distinct()
    return whole.join(proper, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """Chat-template text of the kept conversations."""
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    part = F.struct(F.col("turn"), F.col("role"), F.col("text"), line.alias("line"))
    body = turns.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return kept.join(body, "conv_id").select("conv_id", "n_turns", "n_copies", F.array_join(F.col("parts.line"), "").alias("rendered"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return render(turns, maximal_conversations(turns))


OP1_SQL = """
with t as (select conv_id, role, text, turn,
                  row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n,
                  count(*) over (partition by conv_id) as n_turns,
                  case when role is null then 'N' else 'R' || length(role) || ':' || role end
                    || case when text is null then 'N' else 'T' || length(text) || ':' || text end as item,
                  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) as line
           from conversations where conv_id is not null),
p as (select conv_id, n, n_turns, string_agg(item, ',') over (partition by conv_id order by n) as pre,
             string_agg(line, '') over (partition by conv_id order by n) as rendered from t),
w as (select n, pre, min(conv_id) as conv_id, count(*) as n_copies, min(rendered) as rendered from p where n = n_turns group by n, pre)
select conv_id, n as n_turns, n_copies, rendered from w
where not exists (select 1 from p where p.n = w.n and p.pre = w.pre and p.n < p.n_turns)
"""
