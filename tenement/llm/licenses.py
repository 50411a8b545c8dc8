"""License scans by diagonal voting."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, cut, table

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Template lines of the method's own labels.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3"],
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"],
}
K = 2
FEW = 500_000
GROUP = ("doc_id", "key", "tid", "label", "is_base", "n_grams", "run")


def license_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def template_grams(spark: SparkSession, base: dict = BASE, templates: dict | DataFrame = TEMPLATES) -> DataFrame:
    """Rows tid, label, is_base, n_grams, t_at, a, b, h: every word pair of every template. ``templates`` maps labels to lines, or is a table of
    label and text, such as whole licences of any number."""
    lines = spark.createDataFrame([(p, label, True) for p, label in base.items()], "text string, label string, is_base boolean")
    if isinstance(templates, dict):
        templates = spark.createDataFrame([(t, label) for label, ts in templates.items() for t in ts], "text string, label string")
    rows = lines.unionByName(templates.select("text", "label", F.lit(False).alias("is_base"))).where("label is not null")
    rows = rows.select("label", "is_base", F.xxhash64("text", "label", "is_base").alias("tid"), license_words(F.col("text")).alias("w")).where(F.size("w") >= K).dropDuplicates(["tid"])
    pairs = F.posexplode(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("t_at", "p")
    return rows.select("tid", "label", "is_base", (F.size("w") - K + 1).alias("n_grams"), pairs).select("tid", "label", "is_base", "n_grams", "t_at", "p.a", "p.b", F.xxhash64("p.a", "p.b").alias("h"))


@F.pandas_udf(T.StructType([T.StructField(name, T.IntegerType()) for name in ("held", "first", "last")]))
def best_window(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The window of at most ``width`` words that starts before ``middle`` and holds most different template places; the first of equals.

    ``at``, ``t_at``: places of a stretch and of the template, in order of ``at``.
    """
    def best(at, t_at, middle: int, width: int) -> tuple[int, int, int]:
        inside, end, out = Counter(), 0, (0, 0, 0)
        for first, place in zip(at, t_at, strict=True):
            if first >= middle:
                break
            while end < len(at) and at[end] < first + width:
                inside[t_at[end]] += 1
                end += 1
            if len(inside) > out[0]:
                out = (len(inside), first, at[end - 1])
            inside[place] -= 1
            if not inside[place]:
                del inside[place]
        return out

    for columns in batches:
        yield pd.DataFrame([best(*row) for row in zip(*columns, strict=True)], columns=["held", "first", "last"])


def long_runs(lines: DataFrame) -> DataFrame:
    """Best windows of runs whose span is twice their template or more: a run is laid out in stretches of twice the template, each searched with the
    next one, so every window lies whole in the stretch where it starts, and no task holds more than such a stretch."""
    width = 2 * F.col("n_grams")
    hits = lines.select(*GROUP, F.explode("held").alias("t_at"), "diag").withColumn("at", F.col("diag") + F.col("t_at"))
    hits = hits.withColumn("stretch", F.explode(F.array(F.floor(F.col("at") / width), F.floor(F.col("at") / width) - 1)))
    hits = hits.groupBy(*GROUP, "stretch").agg(F.array_sort(F.collect_set(F.struct("at", "t_at"))).alias("hits"))
    window = best_window("hits.at", "hits.t_at", (F.col("stretch") + 1) * width, width)
    return hits.select(*GROUP, window.alias("b")).select(*GROUP, "b.held", "b.first", "b.last")


def license_spans(docs: DataFrame, base: dict = BASE, templates: dict | DataFrame = TEMPLATES, coverage: float = 0.6, drift: int = 2) -> DataFrame:
    """doc_id, key, label, is_base, first, last, share: verified places.

    Word pairs vote for (template, offset); a base phrase needs all its pairs on one diagonal. For the others diagonals
    at most ``drift`` apart merge (words put in or left out), and a window of the run, under twice the template long, must hold ``coverage`` of the template's pairs.
    """
    words = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), license_words(F.col("text")).alias("w"))
    pairs = words.select("doc_id", "key", F.posexplode(F.arrays_zip(F.col("w").alias("x"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("y"))).alias("at", "p"))
    pairs = pairs.select("doc_id", "key", "at", F.col("p.x").alias("x"), F.col("p.y").alias("y")).where("y is not null").withColumn("h", F.xxhash64("x", "y"))
    grams = cut(template_grams(docs.sparkSession, base, templates))
    votes = pairs.join(F.broadcast(grams) if grams.count() <= FEW else grams, "h").where("x = a and y = b")
    lines = votes.groupBy("doc_id", "key", "tid", "label", "is_base", "n_grams", (F.col("at") - F.col("t_at")).alias("diag")).agg(
        F.collect_set("t_at").alias("held"), F.min("at").alias("first"), F.max("at").alias("last"))
    w = Window.partitionBy("doc_id", "key", "tid").orderBy("diag")
    apart = F.when(F.col("is_base") | (F.col("diag") - F.lag("diag").over(w) > drift), 1).otherwise(0)
    runs = lines.withColumn("apart", apart).withColumn("run", F.sum("apart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    span = Window.partitionBy("doc_id", "key", "tid", "run")
    runs = cut(runs.withColumn("long", F.max("last").over(span) - F.min("first").over(span) >= 2 * F.col("n_grams")))
    spans = runs.where("not long").groupBy(*GROUP).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"), F.min("first").alias("first"), F.max("last").alias("last"))
    spans = spans.union(long_runs(runs.where("long")))
    share = F.col("held") / F.col("n_grams")
    fits = F.when(F.col("is_base"), share == 1.0).otherwise(share >= coverage)
    return spans.where(fits).select("doc_id", "key", "label", "is_base", F.col("first").cast("long"), (F.col("last") + 1).cast("long").alias("last"), share.alias("share"))


def scan(docs: DataFrame, **options) -> DataFrame:
    """One row per row of documents. Null text counts as empty; repeated rows score alike; further columns are ignored."""
    found = license_spans(docs, **options).groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.count_if("is_base").alias("n_base"), F.min(F.when(F.col("is_base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("is_base"), F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    text = F.coalesce("text", F.lit(""))
    n_words = F.regexp_count(ascii_lower(text), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    all_docs = docs.select("doc_id", F.xxhash64(text).alias("key"), n_words.cast("long").alias("n_words"))
    out = all_docs.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
