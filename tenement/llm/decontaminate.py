"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import ascii_lower, cut, fresh, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 3
BROADCAST_ROWS = 2_000_000


def _words(df: DataFrame) -> DataFrame:
    return df.withColumn("w", F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORDS), F.lit(0)))


def grams(df: DataFrame, n: int = N, wanted: np.ndarray | None = None) -> DataFrame:
    """df's columns but ``text``, at, h: one row per run of n words of every text, or those in ``wanted`` (sorted hashes) only.

    Words are hashed once and a run's hash is rolled from theirs, by array steps over slices of a few megabytes of text.
    """
    keys = [f for f in df.schema if f.name != "text"]
    held = None if wanted is None else df.sparkSession.sparkContext.broadcast(wanted)  # at most BROADCAST_ROWS hashes

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.raw(batch.column(len(keys)))
            for i, j in tokens.slices(offsets):
                words, ends = tokens.word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], tokens.SIGNS)
                h, text, at = tokens.runs(words, ends, n)
                if held is not None and len(h):
                    among = np.minimum(np.searchsorted(held.value, h), max(len(held.value) - 1, 0))
                    keep = np.flatnonzero(held.value[among] == h) if len(held.value) else np.zeros(0, dtype=np.int64)
                    h, text, at = h[keep], text[keep], at[keep]
                if len(h):
                    rows = batch.slice(i, j - i).take(pa.array(text))
                    yield pa.RecordBatch.from_arrays([*rows.columns[:len(keys)], pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))], [*(f.name for f in keys), "at", "h"])

    return df.select(*(f.name for f in keys), "text").mapInArrow(find, T.StructType([*keys, T.StructField("at", T.IntegerType()), T.StructField("h", T.LongType())]))


def seeds(items: DataFrame, shared: int = 2) -> list[tuple[int, DataFrame]]:
    """Run length and table (h, item_id, n, i_at, n_seeds) of the rare n-grams of ``items`` (item_id, n, text; texts all different).

    An n-gram is rare that at most ``shared`` items hold. An item takes its rare runs of N words; one without any goes on to runs twice as
    long, and so on. Runs of over half an item are taken though they are not rare: whatever holds one matches that item. So a phrase that many
    items share is no seed, and the hits grow with the texts plus the pairs found. n_seeds is the number of seeds of the item.
    """
    size, left, out = N, cut(items.select("item_id").where(F.col("n") >= N)), []
    while not left.isEmpty():  # at most log2(longest item / N) + 1 times
        found = cut(grams(items.select("item_id", "n", "text"), size))
        spread = found.groupBy("h").agg(F.count_distinct("item_id").alias("spread"))
        mine = found.join(left, "item_id").join(spread, "h").where((F.col("spread") <= shared) | (F.col("n") < 2 * size))
        mine = cut(mine.select("h", "item_id", "n", F.col("at").alias("i_at"), F.count(F.lit(1)).over(Window.partitionBy("item_id")).alias("n_seeds")))
        out.append((size, mine))
        left, size = cut(left.join(mine, "item_id", "left_anti")), 2 * size
    return out


def align(a: np.ndarray, b: np.ndarray) -> float:
    """Smith-Waterman over words (match 2, else -1), as a share of the best possible score of ``a``."""
    j = np.arange(len(b) + 1)
    row, best = np.zeros(len(b) + 1, dtype=np.int64), 0
    for x in a:
        new = np.maximum(row - 1, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == x, 2, -1))
        row = np.maximum.accumulate(new + j) - j
        best = max(best, int(row.max()))
    return best / (2 * len(a)) if len(a) else 0.0


def text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _wanted(seeds_of: DataFrame) -> np.ndarray | None:
    """The sorted distinct hashes of a table of seeds, if there are no more than BROADCAST_ROWS; else none, and all runs are joined."""
    each = seeds_of.select("h").distinct()
    return np.sort(np.array([r.h for r in each.collect()], dtype=np.int64).view(np.uint64)) if each.count() <= BROADCAST_ROWS else None


def short_pairs(texts: DataFrame, items: DataFrame) -> DataFrame:
    """key, item_id, score 1: texts that hold an item of under N words as a run of words."""
    out = texts.sparkSession.createDataFrame([], f"key long, item_id {items.schema['item_id'].dataType.simpleString()}, score double")
    short = cut(items.where(F.size("w").between(1, N - 1)).select("item_id", "n", "text"))
    for n in sorted(r.n for r in short.select("n").distinct().collect()):  # at most N - 1 lengths
        whole = cut(grams(short.where(F.col("n") == n).select("item_id", "text"), n).select("item_id", "h"))
        found = grams(texts.select("key", "text"), n, _wanted(whole)).select("key", "h").distinct()
        out = out.union(found.join(_small(whole), "h").select("key", "item_id", F.lit(1.0).alias("score")).distinct())
    return out


def class_pairs(texts: DataFrame, items: DataFrame, min_score: float, min_seeds: int) -> DataFrame:
    """key, item_id, score of the pairs of ``texts`` (key, text) and ``items`` (item_id, text, w, n; all different)."""
    votes = texts.sparkSession.createDataFrame([], f"key long, item_id {items.schema['item_id'].dataType.simpleString()}, n int, n_seeds long, i_at int, place long")
    for size, found in seeds(items):
        hits = grams(texts, size, _wanted(found)).join(_small(found), "h")
        # A seed votes for the stretch of item length that holds its diagonal and for the next one, so every alignment has a whole one.
        place = F.floor((F.col("at") - F.col("i_at")) / F.col("n"))
        votes = votes.union(hits.select("key", "item_id", "n", "n_seeds", "i_at", F.explode(F.array(place, place + 1)).alias("place")))
    spots = votes.groupBy("key", "item_id", "n", "n_seeds", "place").agg(F.count_distinct("i_at").alias("k")).where(F.col("k") >= F.least(F.lit(min_seeds), "n_seeds"))
    spots = cut(spots.groupBy("key", "item_id", "n").agg(F.array_sort(F.collect_set("place")).alias("places")))
    hit = _small(cut(spots.select("key").distinct()))
    found = texts.join(hit, "key", "left_semi").dropDuplicates(["key"])
    windows = spots.withColumn("place", F.explode("places")).join(_words(found).drop("text"), "key")
    start = F.greatest(F.lit(0), (F.col("place") - 1) * F.col("n") - 4)
    windows = windows.select("key", "item_id", F.slice("w", (start + 1).cast("int"), (3 * F.col("n") + 8).cast("int")).alias("b"))
    pairs = windows.join(items.select("item_id", F.col("w").alias("a")), "item_id")

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([align(np.asarray(x, dtype=object), np.asarray(y, dtype=object)) for x, y in zip(a, b, strict=True)], dtype="float64")

    scores = pairs.select("key", "item_id", score("a", "b").alias("score")).groupBy("key", "item_id").agg(F.max("score").alias("score")).where(F.col("score") >= min_score)
    return cut(scores.unionByName(short_pairs(texts, items)))


def text_pairs(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5, min_seeds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Pairs (key, the hash of the text; item_id; score) whose best local alignment reaches ``min_score``, and items (item_id, n, members).

    A pair needs ``min_seeds`` seeds (all, if the item has fewer) near one diagonal. Items of under N words match where the text holds all of their words in a run.
    Equal texts are aligned once, items of equal words too: ``members`` are their ids, item_id the smallest. Null texts are empty; null item ids are left out; of
    texts that share an item id the greatest counts. The seed table and the keys of texts with votes are broadcast up to BROADCAST_ROWS rows each and shuffled beyond.
    """
    items = _words(benchmark.where("item_id is not null").groupBy("item_id").agg(F.max("text").alias("text")))
    items = items.groupBy("w").agg(F.min("item_id").alias("first"), F.min("text").alias("text"), F.array_sort(F.collect_list("item_id")).alias("members"))
    items = cut(items.select(F.col("first").alias("item_id"), "text", "w", F.size("w").alias("n"), "members"))
    return class_pairs(docs.select(text_key().alias("key"), "text"), items.drop("members"), min_score, min_seeds), items.select("item_id", "n", "members")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5, min_seeds: int = 2) -> DataFrame:
    """doc_id, item_id, score of text_pairs, the best one per doc_id; a null doc_id is searched like any other. Further columns are ignored."""
    pairs, items = text_pairs(docs, benchmark, min_score, min_seeds)
    pairs = _small(cut(pairs.join(items, "item_id").select("key", "score", F.explode("members").alias("item_id"))))
    return docs.select("doc_id", text_key().alias("key")).join(pairs, "key").groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, short: int = 5, short_spread: int = 10) -> DataFrame:
    """docs without the rows whose text holds a benchmark passage. An item of under ``short`` words removes rows only if at most ``short_spread`` different texts
    hold it: what many texts hold in so few words is common language (an item that is "the" removes nothing)."""
    (key,) = fresh(docs, "key")
    pairs, items = text_pairs(docs, benchmark)
    common = pairs.join(items.where(F.col("n") < short), "item_id").groupBy("item_id").agg(F.count_distinct("key").alias("texts")).where(F.col("texts") > short_spread)
    bad = _small(cut(pairs.join(common, "item_id", "left_anti").select(F.col("key").alias(key)).distinct()))
    return docs.join(bad, text_key() == F.col(key), "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
