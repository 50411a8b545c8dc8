"""Resampling to a target distribution: importance weights of hashed word n-grams from arrays, and an exact cutoff key by weighted medians of partition medians."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, removed, shared_dir, table
from .tokens import LOWER, SIGNS, raw, slices

BUCKETS, ORDERS = 10_000, 3
#: Words of a block, and bytes of the longest word that is hashed by array steps.
BLOCK, LONG = 1 << 18, 64
#: Median rows of one pass over the keys, and how far keys must shrink before those that remain are written anew.
CHUNK, SHRINK = 1 << 20, 8
CRC = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32


def _steps() -> np.ndarray:
    """Register after one byte, for each value of its low byte."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = (r >> np.uint32(1)) ^ np.where(r & np.uint32(1), np.uint32(CRC), np.uint32(0))
    return r


STEP = _steps()


def _shifts(most: int) -> np.ndarray:
    """The register after n zero bytes as the sum of what each of its four bytes gives: [n, byte, value]."""
    out = np.empty((most + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(most):
        out[n + 1] = STEP[out[n] & np.uint32(255)] ^ (out[n] >> np.uint32(8))
    return out


SHIFT = _shifts(LONG + 1)
_start = np.full(1, 0xFFFFFFFF, dtype=np.uint32)
START = np.empty(ORDERS * (LONG + 1) + 1, dtype=np.uint32)
for _n in range(len(START)):
    START[_n] = _start[0]
    _start = STEP[_start & np.uint32(255)] ^ (_start >> np.uint32(8))


def shifted(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers after n zero bytes each."""
    out = SHIFT[n, 0, r & np.uint32(255)]
    for k in range(1, 4):
        out ^= SHIFT[n, k, (r >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word of lower-cased ``data``, and the n + 1 offsets of each text's words."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~SIGNS[data]
    here = inside[1:-1]
    first, last = here & ~inside[:-2], here & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts], last[cuts - 1] = here[cuts], here[cuts - 1]
    a = np.flatnonzero(first)
    return a, np.flatnonzero(last) + 1, np.searchsorted(a, offsets, "left")


def gram_crcs(data: np.ndarray, a: np.ndarray, e: np.ndarray, order: int) -> list[np.ndarray]:
    """CRC-32 of the 1 to ``order`` words from each word on, joined by one blank; [n][i] counts only where i + n < len(a).

    CRC-32 is linear: the register of joined texts is that of the first, moved on by the length of the second, plus that of the second. Words of over LONG bytes
    and what holds them go through zlib.
    """
    n, size = len(a), e - a
    long = size > LONG
    short = np.where(long, 0, size)
    by = np.argsort(-short, kind="stable")
    reach = np.searchsorted(-short[by], -np.arange(1, LONG + 1), "right")  # words of at least so many bytes
    r, start = np.zeros(n, dtype=np.uint32), a[by]
    for k in range(int(short.max(initial=0))):
        m = reach[k]
        r[:m] = STEP[(r[:m] ^ data[start[:m] + k]) & np.uint32(255)] ^ (r[:m] >> np.uint32(8))
    word = np.empty(n, dtype=np.uint32)
    word[by] = r
    behind = shifted(np.full(n, STEP[32], dtype=np.uint32), short) ^ word  # of a blank and the word
    out, so_far, total = [word ^ START[short] ^ np.uint32(0xFFFFFFFF)], word, short
    for k in range(1, order):
        m = max(n - k, 0)
        so_far, total = shifted(so_far[:m], short[k:] + 1) ^ behind[k:], total[:m] + short[k:] + 1
        out.append(so_far ^ START[total] ^ np.uint32(0xFFFFFFFF))
    if long.any():
        text = data.tobytes()
        for k in range(order):
            for i in np.unique(np.concatenate([np.flatnonzero(long) - j for j in range(k + 1)])).tolist():
                if 0 <= i < n - k:
                    out[k][i] = zlib.crc32(b" ".join(text[a[j]:e[j]] for j in range(i, i + k + 1)))
    return out


def gram_buckets(column: pa.Array, order: int = ORDERS, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Row range, words of each row, and for each n buckets and rows of the n-grams, in blocks of BLOCK words; a long text is several blocks of one range, of which all but the last give
    no words."""
    bytes_, offsets = raw(column)
    for i, j in slices(offsets):
        data = LOWER[bytes_[offsets[i]:offsets[j]]]
        a, e, at = word_bounds(data, offsets[i:j + 1] - offsets[i])
        words = np.diff(at)
        starts = range(0, max(len(a), 1), BLOCK)
        for s in starts:
            t = min(s + BLOCK + order - 1, len(a))
            lo = int(a[s]) if s < len(a) else 0
            crc = gram_crcs(data[lo:int(e[t - 1]) if t > s else lo], a[s:t] - lo, e[s:t] - lo, order)
            row = np.searchsorted(at, np.arange(s, t), "right") - 1
            own, found = min(BLOCK, t - s), []
            for k, c in enumerate(crc):
                m = min(own, len(c))
                same = row[:m] == row[k:k + m]
                found.append(((c[:m][same] % np.uint32(buckets)).astype(np.int64), row[:m][same]))
            yield i, j, words if s == starts[-1] else np.zeros_like(words), found


def bucket_counts(docs: DataFrame, text: str = "text", order: int = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """n-grams in each bucket, repeats counted. A task sends its own counts, at most ``buckets`` rows; the driver gets that many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, found in gram_buckets(batch.column(0), order, buckets):
                for b, _ in found:
                    total += np.bincount(b, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in docs.select(F.col(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """A bucket's gain: the log ratio of its smoothed shares in target and source, in thousandths, floored."""
    s, t, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(scale * math.log((y + 1.0) * (s + k) / ((x + 1.0) * (t + k)))) for x, y in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", order: int = ORDERS) -> DataFrame:
    """key, tie (a hash of the text), n_words, n_features and weight of every row; null texts have none. Other columns are ignored."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for i, j, w, found in gram_buckets(batch.column(2), order, buckets):
                words[i:j] += w
                for b, row in found:
                    features[i:j] += np.bincount(row, minlength=j - i)
                    sums = np.zeros(len(b) + 1, dtype=np.int64)
                    np.cumsum(gain[b], out=sums[1:])
                    ends = np.searchsorted(row, np.arange(j - i + 1), "left")
                    weight[i:j] += np.diff(sums[ends])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, (words, features, weight))], [key, "tie", "n_words", "n_features", "weight"])

    rows = docs.select(key, F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, tie long, n_words long, n_features long, weight long")


def weighted_median(values: np.ndarray, sizes: np.ndarray) -> int:
    """The value at which half of all sizes is reached."""
    by = np.argsort(values, kind="stable")
    total = np.cumsum(sizes[by])
    return int(values[by][np.searchsorted(total, (total[-1] + 1) // 2)])


def _pass(keys: DataFrame, pivot: int | None) -> np.ndarray:
    """From each partition: keys above the pivot, equal to it, below, and the median of those above and below (without a pivot all are above). A partition of over CHUNK keys sends the
    weighted median of its chunks' medians."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes, count = [], 0, [0, 0, 0]
        medians: tuple[list, list] = ([], [])

        def close() -> None:
            nonlocal held, sizes
            v = np.concatenate(held)
            parts = (v, v[:0], v[:0]) if pivot is None else (v[v > pivot], v[v == pivot], v[v < pivot])
            for k, part in enumerate(parts):
                count[k] += len(part)
            for out, part in zip(medians, parts[::2], strict=True):
                if len(part):
                    out.append((int(np.partition(part, (len(part) - 1) // 2)[(len(part) - 1) // 2]), len(part)))
            held, sizes = [], 0

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            sizes += batch.num_rows
            if sizes >= CHUNK:
                close()
        if held:
            close()
        both = [weighted_median(*map(np.array, zip(*m, strict=True))) if m else 0 for m in medians]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*count, *both)], list("nempq"))

    rows = keys.mapInArrow(run, "n long, e long, m long, p long, q long").collect()
    return np.array([tuple(r) for r in rows], dtype=np.int64).reshape(-1, 5)


def nth_greatest(keys: DataFrame, k: int) -> tuple[int, int, int]:
    """The k-th greatest (k >= 1) of the one long column of ``keys`` (without nulls, stored), how many are greater and how many equal to it.

    A pass gives the medians of the partitions' remaining keys, weighted by how many remain there; their weighted median is the next pivot. At least a quarter of the keys lies on
    either side of it (an eighth where partitions are larger than a chunk), so each pass discards that share for certain, until the pivot is the key. One row per partition comes to the driver.
    When an eighth remains, it is written to the shared folder and later passes read that, so all passes together read about as much as two or three over all keys.
    """
    spark, name = keys.sparkSession, keys.columns[0]
    c, now, path, above = F.col(keys.columns[0]), keys, None, 0
    got = _pass(now, None)
    held = left = int(got[:, 0].sum())
    assert 1 <= k <= left
    sides, medians = got[:, 0], got[:, 3]
    while True:
        pivot = weighted_median(medians[sides > 0], sides[sides > 0])
        got = _pass(now, pivot)
        more, equal = int(got[:, 0].sum()), int(got[:, 1].sum())
        if above + more < k <= above + more + equal:
            if path:
                removed(spark, path)
            return pivot, above + more, equal
        up = above + more >= k
        sides, medians = (got[:, 0], got[:, 3]) if up else (got[:, 2], got[:, 4])
        above, left = (above, more) if up else (above + more + equal, left - more - equal)
        now = now.where(c > pivot if up else c < pivot)
        if left * SHRINK < held:
            old, path = path, f"{shared_dir(spark)}/keys-{uuid.uuid4().hex}"
            now.write.parquet(path)
            now, held = spark.read.schema(f"`{name}` long").parquet(path), left
            if old:
                removed(spark, old)


def _first(rows: DataFrame, columns: list[str], k: int):
    """Condition of the k rows of ``rows`` that come first by the columns, greatest first; the last column has no ties. Each further column is looked at where the one before it ties at the
    cutoff."""
    ties, out = F.lit(True), F.lit(False)
    for name in columns:
        value, above, equal = nth_greatest(rows.where(ties).select(name), k)
        out = out | (ties & (F.col(name) > value))
        ties = ties & (F.col(name) == value)
        k -= above
        if k == equal:
            break
    return out | ties


def drawn(scored: DataFrame, k: int, columns: list[str]) -> DataFrame:
    """``scored`` (stored) with ``rank`` 1 to k for the k rows that come first by the columns, greatest first, and null for the others: found by their cutoff key, then only the winners are sorted."""
    if k == 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    wins = _first(scored, columns, k)
    # Range partitions in order; within one, the row's number. The sorted rows are stored, so numbers hold whatever is run again.
    part = scored.where(wins).sort(*map(F.desc, columns)).withColumn("_place", F.monotonically_increasing_id())
    part = cut(part.withColumns({"_part": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)}))
    before, sizes = 0, {}
    for r in part.groupBy("_part").count().sort("_part").collect():  # one row a partition
        sizes[r["_part"]], before = before, before + r["count"]
    ahead = scored.sparkSession.createDataFrame(list(sizes.items()), "_part long, _ahead long")
    ranked = part.join(F.broadcast(ahead), "_part").withColumn("rank", F.col("_ahead") + F.col("_place") + 1).drop("_part", "_place", "_ahead")
    return scored.where(~wins).withColumn("rank", F.lit(None).cast("long")).unionByName(ranked)


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score, rank: documents drawn without replacement to look like ``target``, by their greatest Gumbel scores, rank 1 first.

    ``percent`` of the rows with at least ``least`` words are drawn; other rows keep a null rank. Null texts have no words and weight 0; a null doc_id draws as an empty one and
    loses ties. Ties go to the smaller doc_id, then by text, then in any order (such rows are equal). Every repeated row counts. Empty tables give no rows; an empty target weighs by
    the source alone. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = weighted(docs, gain).withColumn("score", F.col("weight") + gumbel)
    path = f"{shared_dir(docs.sparkSession)}/scored-{uuid.uuid4().hex}"
    # Keys are compared as longs, greatest first; the last one has no ties.
    rows = rows.withColumns({"by_id": F.when(F.col("doc_id").isNull(), F.lit(-(1 << 63))).otherwise(F.bitwise_not(F.col("doc_id").cast("long"))), "line": F.monotonically_increasing_id()})
    rows.write.parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    enough = F.col("n_words") >= least
    n = rows.where(enough).count()
    out = drawn(rows.where(enough), percent * n // 100, ["score", "by_id", "tie", "line"])
    return out.unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
