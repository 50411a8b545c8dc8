"""Near-duplicates at a Jaccard similarity of word shingles: SimHash anchors and MinHash bands propose groups, exact shingle sets decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, workers
from .simhash import anchors, components, majority

WORDS, BANDS, ROWS, BLOCK = 5, 20, 5, 4096
FEW, BLOCK_TEXTS, BLOCK_SHINGLES = 64, 256, 1 << 17
_draw = np.random.default_rng(11)
MULTIPLY = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Distinct hashes of the runs of k lower-case words; fewer words are one run."""
    words = (text or "").lower().encode("utf-8").split()
    grams = [b" ".join(words)] if len(words) < k else map(b" ".join, zip(*(words[i:] for i in range(k))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype=np.uint64))


def bands(h: np.ndarray) -> np.ndarray:
    """One hash per band of ROWS minima of a text's shingles. Texts of Jaccard 0.8 share no band with a chance of 0.0004."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(h), BLOCK):
        x = h[i:i + BLOCK, None] * MULTIPLY + ADD
        low = np.minimum(low, (x ^ (x >> np.uint64(29))).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(low[b * ROWS:(b + 1) * ROWS].tobytes(), b) for b in range(BANDS)], dtype=np.uint64).view(np.int64)


def marks(text: str | None) -> np.ndarray:
    """The bands of a text, then the SimHash fingerprint of its shingles."""
    h = shingles(text)
    return np.append(bands(h), majority(h))


def families(marked: DataFrame) -> DataFrame:
    """key, band: texts whose fingerprints (fp) are equal, or linked by steps of shared anchors, have the same.

    By the anchor covering of ``simhash``: any two fingerprints within 2 bits share an anchor. Members of an anchor are tied to its least one, as the shingle sets decide
    later: a group of n near copies gives up to 33 n ties in place of n * n links.
    """
    points = marked.select("fp").distinct().repartition(workers(marked.sparkSession), "fp")
    met = points.select("fp", F.explode(anchors(F.col("fp"))).alias("anchor")).groupBy("anchor").agg(F.collect_list("fp").alias("m")).where(F.size("m") > 1)
    ties = met.select(F.explode("m").alias("u"), F.array_min("m").alias("v")).where("u <> v").distinct()
    roots = components(ties).withColumnRenamed("u", "fp")
    return marked.select("key", "fp").join(roots, "fp", "left").select("key", F.coalesce("root", "fp").alias("band"))


def arrays(f: Callable[[str | None], np.ndarray]) -> Callable[[str], Column]:
    """f, of a text, as a column function."""
    @F.pandas_udf("array<long>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([f(t).view(np.int64) for t in s], dtype=object)

    return of


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """u, v of the pairs whose shingle sets have a Jaccard similarity of ``least`` or more."""
    both = pairs.join(sets.select(F.col("key").alias("u"), F.col("s").alias("a")), "u").join(sets.select(F.col("key").alias("v"), F.col("s").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(shared >= least * (F.size("a") + F.size("b") - shared)).select("u", "v")


def similar_in_blocks(apart: DataFrame, near: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """u, v: all x of ``apart`` (x, hub) similar to a y of the same hub in ``near`` (y, hub), by matrix products over blocks of texts.

    A block holds about BLOCK_TEXTS texts and BLOCK_SHINGLES shingles, so a group of any size is spread over many rows, and only
    links come out.
    """
    def blocks(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col(df.columns[0]).alias("key"), "hub").join(sets, "key")
        cuts = rows.groupBy("hub").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum(F.size("s")) / BLOCK_SHINGLES)).alias("cuts"))
        rows = rows.join(cuts, "hub").groupBy("hub", F.pmod(F.xxhash64("key"), F.col("cuts")).alias("cut")).agg(F.collect_list(F.struct("key", "s")).alias("m"))
        return rows.select("hub", *[x.alias(f"{name}_{k}") for k, x in (("key", F.col("m.key")), ("n", F.transform("m", lambda x: F.size(x["s"]))), ("s", F.flatten("m.s")))])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                common = np.intersect1d(r.a_s, r.b_s)
                sides = [(np.repeat(np.arange(len(n)), n), np.searchsorted(common, s), np.isin(s, common)) for n, s in ((r.a_n, np.asarray(r.a_s)), (r.b_n, np.asarray(r.b_s)))]
                shared = np.zeros((len(r.a_n), len(r.b_n)))
                for c in range(0, len(common), BLOCK):
                    a, b = (np.zeros((len(n), BLOCK), dtype=np.float32) for n in (r.a_n, r.b_n))
                    for m, (row, col, ok) in zip((a, b), sides, strict=True):
                        ok = ok & (col >= c) & (col < c + BLOCK)
                        m[row[ok], col[ok] - c] = 1
                    shared += a @ b.T
                x, y = np.nonzero(shared >= least * (np.asarray(r.a_n)[:, None] + np.asarray(r.b_n)[None, :] - shared))
                x, y = np.asarray(r.a_key)[x], np.asarray(r.b_key)[y]
                yield pd.DataFrame({"u": np.maximum(x, y)[x != y], "v": np.minimum(x, y)[x != y]})

    met = blocks(apart, "a").join(blocks(near, "b").hint("merge"), "hub").repartition(workers(apart.sparkSession))
    return met.mapInPandas(compare, "u long, v long").distinct()


def similar_links(texts: DataFrame, least: float = 0.8) -> DataFrame:
    """key, text (one row per key) -> links (u > v) that connect all texts of similarity ``least`` that share a band, or whose fingerprints are linked.

    SimHash finds all pairs within 2 bits, which are the closest copies; texts of similarity 0.8 differ in about 10 bits, so bands propose the
    others. The texts of linked fingerprints are one more group. The hub of a band's group is its member with the largest groups, so that the groups around one text share their hub. All members
    are compared with it; two members similar to it need no link of their own. Those not similar to it are compared with all
    texts around the hub, in blocks where these are many, so that no pair is left out.
    """
    marked = cut(texts.select("key", arrays(marks)("text").alias("m")).select("key", F.slice("m", 1, BANDS).alias("bands"), F.element_at("m", -1).alias("fp")))
    sent = marked.select("key", F.explode("bands").alias("band")).union(families(marked))
    groups = sent.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(sent.join(groups, "band"))
    weight = members.groupBy("key").agg(F.sum("n").alias("weight"))
    hubs = members.join(weight, "key").groupBy("band").agg(F.max_by("key", F.struct("weight", "key")).alias("hub"))
    near = cut(members.join(hubs, "band").select(F.col("key").alias("x"), "hub").distinct())
    sets = cut(texts.join(near.select(F.col("x").alias("key")).distinct(), "key", "left_semi").repartition(workers(texts.sparkSession), "key").select("key", arrays(shingles)("text").alias("s")))
    stars = near.where("x <> hub")
    linked = cut(similar(stars.select(F.col("x").alias("u"), F.col("hub").alias("v")), sets, least))
    apart = stars.join(linked, (F.col("x") == F.col("u")) & (F.col("hub") == F.col("v")), "left_anti")
    apart = cut(apart.join(near.groupBy("hub").agg(F.count(F.lit(1)).alias("n")), "hub"))
    rest = apart.where(F.col("n") <= FEW).select("x", "hub").join(near.withColumnRenamed("x", "y"), "hub").where("y <> x and y <> hub")
    rest = similar(rest.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), sets, least)
    many = similar_in_blocks(apart.where(F.col("n") > FEW).select("x", "hub"), near.join(apart.where(F.col("n") > FEW).select("hub").distinct(), "hub", "left_semi").select("x", "hub"), sets, least)
    return linked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).union(rest).union(many).distinct()


def one_of_each(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One row of every group of near copies: the one of smallest doc_id (rows without id come last), then of smallest text hash.

    Equal texts are one node, keyed by their hash, so rows without id take part like any other. Null text counts as empty.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", key.alias("key"))
    texts = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["key"])
    roots = components(similar_links(texts, least)).withColumnsRenamed({"u": "key"})
    names = rows.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("name"))
    names = names.join(roots, "key", "left").groupBy(F.coalesce("root", "key")).agg(F.min("name").alias("name"))
    d, k, own = fresh(docs, "d", "k", "key")
    kept = cut(names.select(F.col("name.doc_id").alias(d), F.col("name.key").alias(k)))
    found = docs.withColumn(own, key).join(kept, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(k)), "left_semi")
    return found.dropDuplicates(["doc_id", own]).select(*docs.columns)
