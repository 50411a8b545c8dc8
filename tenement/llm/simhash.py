"""SimHash near-dedup by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, workers

BLOCK = 65536
PER_TASK = 1 << 18  # links that one task reads at least


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), BLOCK):
        votes += np.unpackbits(h[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<i8")[0])


def simhash(text: str | None, k: int = 3) -> int:
    """64-bit fingerprint: bit set when set in over half of the shingle hashes; no words: zero."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < k else map(b" ".join, zip(*(words[i:] for i in range(k))))
    return majority(np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8"))


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp (long) of every document."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([simhash(t, k) for t in s], dtype="int64")

    return docs.select("doc_id", fp("text").alias("fp"))


def anchors(fp: Column) -> Column:
    """The codewords within 2 bits of a fingerprint, 33 or 2 of them.

    The code is the Hamming code of length 63, whose words cover all others within 1 bit, with a free last bit. Place i (1 to 63) is bit i - 1; the syndrome s is
    the XOR of the places of all set bits. A word of syndrome s comes to the code by flipping place s, or places i and i XOR s.
    """
    place = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i - 1)
    masks = [sum(1 << (i - 1) for i in range(1, 64) if i >> k & 1) for k in range(6)]
    syndrome = sum(((F.bit_count(fp.bitwiseAND(F.lit(m))) % 2) * (1 << k) for k, m in enumerate(masks)), F.lit(0))
    free = fp.bitwiseXOR(F.lit(-(1 << 63)))

    def coded(s: Column) -> Column:
        pairs = F.filter(F.sequence(F.lit(1), F.lit(63)), lambda i: i < i.bitwiseXOR(s))
        near = F.array(fp.bitwiseXOR(place(s)), free.bitwiseXOR(place(s)))
        return F.when(s == 0, F.array(fp, free)).otherwise(F.concat(near, F.transform(pairs, lambda i: fp.bitwiseXOR(place(i)).bitwiseXOR(place(i.bitwiseXOR(s))))))

    return F.get(F.transform(F.array(syndrome.cast("int")), coded), 0)


def anchor_links(points: DataFrame) -> DataFrame:
    """Links (u > v) between all distinct fingerprints that differ in 2 or fewer bits.

    Two such words have one between them, within 1 bit of both, and the code covers that one within 1 bit: so they share a codeword within 2 bits of
    both, the covering radius and each end's half of the threshold. Every fingerprint goes to these anchors, and per anchor all members are
    compared. An anchor has at most 2,081 members, the words within 2 bits of it, whatever the data.
    """
    # Dealt out before the growth, which the size of the points does not show.
    points = points.repartition(workers(points.sparkSession), "fp")
    sent = points.select("fp", F.explode(anchors(F.col("fp"))).alias("anchor"))
    met = sent.groupBy("anchor").agg(F.collect_list("fp").alias("m")).where(F.size("m") > 1)
    links = met.select(F.explode("m").alias("u"), "m").select("u", F.explode(F.filter("m", lambda v: (v < F.col("u")) & (F.bit_count(v.bitwiseXOR(F.col("u"))) <= 2))).alias("v"))
    return links.distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, root) for every linked node, by alternating large-star and small-star steps; each round is cut in the shared folder.

    A round has two shuffles, by the node of the large and of the small star: the links of a node lie together, so its least neighbour, the join with it and
    the removal of repeats need no further one, and a link in gives at most one link out. The driver keeps a record of every task, so few rows are
    read by few tasks, and tables that differ little in size are merged, as a broadcast collects one of them in the driver.
    """
    edges = cut(links)
    seen = _told(edges)
    for _ in range(max_rounds):
        few = edges.coalesce(max(1, -(-seen[0] // PER_TASK)))  # no more partitions than there are
        both = few.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*").repartition("u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").repartition("u").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # One of a node's links goes to its least neighbour: that one ties the node, the others tie its other neighbours.
        edges = cut(large.join(low.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")))
        now = _told(edges.coalesce(max(1, -(-seen[0] // PER_TASK))))
        if now == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = now
    raise RuntimeError("components did not settle")


def _told(edges: DataFrame) -> tuple:
    """The number of links and two sums of their hashes, which tell one set from another, also where links repeat."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def near_duplicates(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) for every row of documents.

    Null and empty texts have fingerprint zero and link like any other; equal rows keep one row each; a null doc_id keeps its
    row and never names a component unless the whole component has no id. Further columns are ignored.
    """
    marked = cut(fingerprints(docs, k))
    points = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = points.join(components(anchor_links(points)).withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(roots.select("fp", "root").join(names, "root").select("fp", "component_id"), "fp")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
