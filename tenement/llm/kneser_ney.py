"""Interpolated modified Kneser-Ney trigram model: counted in Spark, kept as sorted hash arrays, memory-mapped by workers.

A word's id is its place in the sorted array of word hashes, so ids are in the order of hashes and n-grams of ids have no collisions of their own.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import fold, shared_dir, table, written

START, END = np.uint64(1), np.uint64(2)
SHARD = 1 << 20
FLUSH = 1 << 20
PART = 1 << 18
BITS = 21
MANY = 32
FEW = 16
SLICE = 2 << 20
NONE = np.int64(-1)


def mounted(spark: SparkSession) -> str:
    """The shared folder as a path that workers can map; it must be mounted on them."""
    url = urlparse(shared_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError("memory-mapped arrays need a shared folder that is mounted on all machines (file:), not " + url.scheme)
    return f"{url.path}/kn-{uuid.uuid4().hex}"


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end mark, one array; the n + 1 offsets of the texts."""
    h, ends = tokens.word_hashes(data, offsets, tokens.SPACE)
    h[h <= END] += np.uint64(3)  # two values are marks
    out = np.full(len(h) + len(ends) - 1, END, dtype=np.uint64)
    bounds = ends + np.arange(len(ends))
    is_word = np.ones(len(out), dtype=bool)
    is_word[bounds[1:] - 1] = False
    out[is_word] = h
    return out, bounds


def streams(column: pa.Array, limit: int = tokens.BATCH_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, token hashes and offsets of slices of a few megabytes of text."""
    data, offsets = tokens.raw(column)
    for i, j in tokens.slices(offsets, limit):
        yield i, *token_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def trigrams(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes, and the places among them of u, v, w of every token; START stands before a text."""
    known, w = np.unique(h, return_inverse=True)
    known, w = np.concatenate([[START], known]), w + 1
    v = np.roll(w, 1)
    v[bounds[:-1]] = 0
    u = np.roll(v, 1)
    u[bounds[:-1]] = 0
    return known, u, v, w


def packed(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The names that three places below n stand for, and the places as one sortable number each; at most FLUSH places."""
    names = np.arange(n)
    if n >= 1 << BITS:
        names, back = np.unique(np.concatenate([v, u, w]), return_inverse=True)
        v, u, w = np.split(back, 3)
    return names, (v << 2 * BITS) | (u << BITS) | w


def unpacked(key: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    return [names[(key >> s) & ((1 << BITS) - 1)] for s in (2 * BITS, BITS, 0)]


def unigram_counts(docs: DataFrame) -> DataFrame:
    """w, n of all training texts; each slice counts its own words before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, _ in streams(batch.column(0)):
                w, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], ["w", "n"])

    return docs.select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the least unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def counts_of(x: np.ndarray) -> dict[str, np.ndarray]:
    """64-bit counts as one byte each, and those of 255 or more apart."""
    over = np.flatnonzero(x >= 255)
    return {"c": np.minimum(x, 255).astype(np.uint8), "over": over.astype(np.int64), "more": x[over].astype(np.int64)}


def save(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Arrays as files of a new folder: a rerun task writes new ones, and only names of finished tasks are returned."""
    path = f"{folder}/{uuid.uuid4().hex}"
    os.makedirs(path)
    for k, x in arrays.items():
        np.save(f"{path}/{k}.npy", x)
    return path


class Files:
    """Arrays by (path, name), mapped when first used."""

    def __init__(self):
        self.held = {}

    def __call__(self, path: str, name: str) -> np.ndarray:
        if (path, name) not in self.held:
            self.held[path, name] = np.load(f"{path}/{name}.npy", mmap_mode="r").view(np.ndarray)
        return self.held[path, name]


def search(a: np.ndarray, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted stretch a[low:high], or NONE. A stretch that FEW or more neighbours ask for is searched for all of them at once."""
    key = np.clip(x, 0, np.iinfo(a.dtype).max).astype(a.dtype)  # of the same type, so that no stretch is copied; what was clipped is told apart at the end
    low, end, alone = low.astype(np.int64), high.astype(np.int64), low < high
    same = np.flatnonzero((np.diff(low) != 0) | (np.diff(end) != 0)) + 1
    at = np.concatenate([[0], same, [len(x)]]) if len(x) else np.zeros(1, np.int64)
    for k in np.flatnonzero((np.diff(at) >= FEW) & alone[at[:-1]]) if len(x) else ():
        i, j = at[k], at[k + 1]
        low[i:j] += a[low[i]:end[i]].searchsorted(key[i:j])
        alone[i:j] = False
    todo = np.flatnonzero(alone)
    lo, top, want = low[todo], end[todo], key[todo]
    while len(todo):
        mid = (lo + top) >> 1
        up = a[mid] < want
        lo, top = np.where(up, mid + 1, lo), np.where(up, top, mid)
        on = lo < top
        if not on.all():
            low[todo[~on]] = lo[~on]
            todo, lo, top, want = todo[on], lo[on], top[on], want[on]
    hit = np.flatnonzero(low < end)
    hit = hit[a[low[hit]] == x[hit]]
    out = np.full(len(x), NONE)
    out[hit] = low[hit]
    return out


class Vocabulary:
    """Ids and counts of words from sorted hash arrays; ``files``: (first hash, id of the first, tokens before it, path) by range."""

    def __init__(self, files: list[tuple], size: int):
        self.files, self.size, self.read = files, size, Files()
        self.low = np.array([f[0] for f in files], dtype=np.uint64)
        self.base = np.array([f[1] for f in files], dtype=np.int64)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, NONE for unknown ones."""
        out = np.full(len(h), NONE)
        cut = np.searchsorted(h, self.low)
        for k, (a, b) in enumerate(zip(cut, [*cut[1:], len(h)], strict=True)):
            if a < b:
                known = self.read(self.files[k][3], "h")
                i = np.minimum(np.searchsorted(known, h[a:b]), len(known) - 1)
                out[a:b] = np.where(known[i] == h[a:b], i + self.base[k], NONE)
        return out

    def of(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values by sorted ids; 0 for NONE."""
        out = np.zeros(len(ids), dtype=np.int64)
        cut = np.searchsorted(ids, self.base)
        for k, (a, b) in enumerate(zip(cut, [*cut[1:], len(ids)], strict=True)):
            if a < b:
                out[a:b] = self.read(self.files[k][3], name)[ids[a:b] - self.base[k]]
        return out

    def spread(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted ids: the first bucket of each, and how many more it takes."""
        before, n = self.of("before", v) , self.of("n", v)
        return before // SHARD, n // SHARD

    def bucket(self, v: np.ndarray, x: np.ndarray, spread: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Buckets in the order of (v, x): each holds about SHARD tokens; a word of more tokens is dealt over several by x."""
        first, more = spread
        return first + (x * (more + 1)) // max(self.size, 1)


def store_vocabulary(counts: DataFrame, folder: str) -> tuple[Vocabulary, int, int]:
    """The vocabulary, N and V. ``counts`` is a stored table; START joins it, as frequent as the end mark. Hashes are in unsigned order."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches) or [pd.DataFrame({"w": [], "n": []})])
        if len(rows):
            h, n = rows["w"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
            path = save(folder, {"h": h, "n": n, "before": np.cumsum(n) - n})
            yield pd.DataFrame({"low": [int(h[0].view(np.int64))], "words": [len(h)], "tokens": [int(n.sum())], "path": [path]})

    spark = counts.sparkSession
    n, v = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    texts = counts.where(F.col("w") == int(END)).agg(F.sum("n")).first()[0] or 0
    every = counts.union(spark.createDataFrame([(int(START), texts)], "w long, n long"))
    order = [F.col("w") < 0, F.col("w")]
    files = every.repartitionByRange(max(1, -(-v // (4 * SHARD))), *order).sortWithinPartitions(*order).mapInPandas(write, "low long, words long, tokens long, path string")
    files = sorted(files.collect(), key=lambda r: r.low % (1 << 64))  # one row per range
    out, at, before = [], 0, 0
    for r in files:
        out.append((r.low % (1 << 64), at, before, r.path))
        at, before = at + r.words, before + r.tokens
    return Vocabulary(out, at), n or 0, v


RUN = "bucket long, u binary, v binary, w binary, c binary"


def planes(x: np.ndarray, kind: str) -> bytes:
    """Whole numbers as byte planes, which compress well where high bytes repeat."""
    return x.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def unplaned(b: bytes, kind: str, to: str = "<i8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(b, np.uint8).reshape(width, -1).T.copy().view(kind).ravel().astype(to, copy=False)


def trigram_runs(docs: DataFrame, held) -> DataFrame:
    """Sorted runs of distinct trigrams with counts, by bucket of (v, u), after START of (v, w): each flush counts its own before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width = held.value, "<u4" if held.value.size < 1 << 32 else "<u8"

        def flush(parts: list) -> Iterator[pa.RecordBatch]:
            h = np.concatenate([p[0] for p in parts])
            starts = np.concatenate([[0], *(p[1][1:] + o for p, o in zip(parts, np.cumsum([0, *(len(p[0]) for p in parts[:-1])]), strict=True))])
            known, u, v, w = trigrams(h, starts)
            ids = words.ids(known)
            spread = words.spread(ids)
            for a in range(0, len(w), FLUSH):  # only a text of its own is longer than a flush
                names, key = packed(*(x[a:a + FLUSH] for x in (v, u, w)), len(known))
                key, c = np.unique(key, return_counts=True)
                v1, u1, w1 = unpacked(key, names)
                bucket = words.bucket(ids[v1], ids[np.where(v1 == 0, w1, u1)], (spread[0][v1], spread[1][v1]))
                cut = np.flatnonzero(np.diff(bucket)) + 1
                rows = [(int(bucket[i]), planes(ids[u1[i:j]], width), planes(np.diff(ids[v1[i:j]], prepend=0), width), planes(ids[w1[i:j]], width), planes(c[i:j], "<u4")) for i, j in zip([0, *cut], [*cut, len(key)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), *[pa.binary()] * 4), strict=True)], ["bucket", "u", "v", "w", "c"])

        parts, size = [], 0
        for batch in batches:
            for _, h, bounds in streams(batch.column(0)):
                if parts and size + len(h) > FLUSH:
                    yield from flush(parts)
                    parts, size = [], 0
                parts.append((h, bounds))
                size += len(h)
        if parts:
            yield from flush(parts)

    return docs.select("text").mapInArrow(count, RUN)


def starts_of(x: np.ndarray) -> np.ndarray:
    """First places of the stretches of equal values, and the end."""
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)


def kinds(c: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3, 4."""
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5]


def pair_arrays(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted (v, w) with continuation counts: followers of each v, their total and how many have 1, 2, 3 or more."""
    at = starts_of(v)
    sums = lambda x: np.add.reduceat(x.astype(np.int64), at[:-1]) if len(x) else np.zeros(0, np.int64)
    return {"v": v[at[:-1]], "v_at": small(at), "w": small(w), "total": small(sums(c)), "k1": small(sums(c == 1)), "k2": small(sums(c == 2)), "k3": small(sums(c > 2))} | counts_of(c)


def trigram_arrays(u: np.ndarray, v: np.ndarray, w: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted (v, u, w) with counts; of contexts with over MANY followers their sums too."""
    pair = np.concatenate([[0], np.flatnonzero((u[1:] != u[:-1]) | (v[1:] != v[:-1])) + 1, [len(u)]]) if len(u) else np.zeros(1, np.int64)
    at = starts_of(v[pair[:-1]])
    big = np.flatnonzero(np.diff(pair) > MANY)
    sums = {}
    if len(big):
        inside = np.repeat(pair[big] - np.concatenate([[0], np.cumsum(np.diff(pair)[big])[:-1]]), np.diff(pair)[big]) + np.arange(np.diff(pair)[big].sum())
        first = np.cumsum(np.diff(pair)[big]) - np.diff(pair)[big]
        sums = {k: np.add.reduceat(x.astype(np.int64), first) for k, x in zip(("total", "k1", "k2", "k3"), (c[inside], c[inside] == 1, c[inside] == 2, c[inside] > 2), strict=True)}
    return {"v": v[pair[:-1]][at[:-1]].astype(np.int64), "v_at": small(at), "u": small(u[pair[:-1]]), "u_at": small(pair), "w": small(w), "big": small(big)} | {k: small(x) for k, x in sums.items()} | counts_of(c)


def merged(rows: pd.DataFrame, width: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """u, v, w, c of a bucket's runs as one run in the order of (v, u, w). Ids stay of the width in which they came: a bucket of a frequent word has
    several times SHARD entries, and all of them are in memory here."""
    u, w = (np.concatenate([unplaned(b, width, width) for b in rows[k]]) for k in ("u", "w"))
    v = np.concatenate([np.cumsum(unplaned(b, width, width), dtype=width) for b in rows["v"]])  # steps below zero wrap round and back
    order = np.lexsort((w, u, v))
    if len(order) < 1 << 32:
        order = order.astype(np.uint32)
    u, v, w = u[order], v[order], w[order]
    c = np.concatenate([unplaned(b, "<u4", "<u4") for b in rows["c"]])[order]
    del order
    other = (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(np.concatenate([[True], other]))
    return u[first], v[first], w[first], np.add.reduceat(c, first, dtype=np.int64)


STATS = "bucket long, path string, pairs string, k array<long>, kp array<long>, v binary, w binary, c binary, n_bucket long, n_w binary, n_c binary"


def store_trigrams(runs_of: DataFrame, held, folder: str) -> DataFrame:
    """Merge each bucket's runs into sorted arrays on disk, one group a bucket of about SHARD tokens, whatever its words.

    Rows: the bucket's files with its counts of counts; of words dealt over several buckets the pairs of this one, still to be added up;
    and how many different words stand before each word, by range of the word's id.
    """
    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = held.value
        u, v, w, c = merged(rows, "<u4" if words.size < 1 << 32 else "<u8")
        start = 0  # the least hash
        path, ones = save(folder, trigram_arrays(*(x[v != start] for x in (u, v, w, c)))), kinds(c[v != start])
        del u  # stored
        # Continuations: different words before (v, w); after START the counts themselves, as nothing stands before it.
        order = np.lexsort((w, v))
        v, w, c = v[order], w[order], c[order]
        first = np.concatenate([[0], np.flatnonzero((v[1:] != v[:-1]) | (w[1:] != w[:-1])) + 1])
        n = np.diff(np.append(first, len(v)))
        n = np.where(v[first] == start, np.add.reduceat(c, first), n)
        v, w = v[first].astype(np.int64), w[first].astype(np.int64)
        split = words.spread(v)[1] > 0
        whole = pair_arrays(v[~split], w[~split], n[~split])
        got = [(int(key[0]), path, save(folder, whole), ones.tolist(), kinds(n[~split]).tolist(), planes(v[split], "<u8"), planes(w[split], "<u8"), planes(n[split], "<u8"), None, None, None)]
        return pd.DataFrame(got + befores(w[~split], words), columns=[x.split()[0] for x in STATS.split(", ")])

    return runs_of.groupBy("bucket").applyInPandas(merge, STATS)


def befores(w: np.ndarray, words: Vocabulary) -> list[tuple]:
    """Rows of how many pairs end in each word, by range of the word's id."""
    w, n = np.unique(w, return_counts=True)
    part = w // PART
    at = starts_of(part)
    return [(None,) * 8 + (int(part[i]), planes(w[i:j] - part[i] * PART, "<u4"), planes(n[i:j], "<u4")) for i, j in zip(at[:-1], at[1:], strict=True)]


def store_pairs(split: DataFrame, held, folder: str) -> DataFrame:
    """Pairs of words dealt over several buckets: their counts add up, then each bucket of (v, w) is stored like the others; v and w
    of its row hold the words v and their sums in it."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                v, w, c = (unplaned(b, "<u8") for b in (r.v, r.w, r.c))
                if len(v):
                    yield pd.DataFrame({"bucket": held.value.bucket(v, w, held.value.spread(v)), "v": v, "w": w, "c": c})

    def keep(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["v", "w"])
        v, w, c = (rows[k].to_numpy(np.int64) for k in ("v", "w", "c"))
        arrays = pair_arrays(v, w, c)
        sums = np.concatenate([arrays[k].astype(np.int64) for k in ("total", "k1", "k2", "k3")])
        got = [(int(key[0]), None, save(folder, arrays), [0] * 4, kinds(c).tolist(), planes(arrays["v"], "<u8"), planes(sums, "<u8"), None, None, None, None)]
        return pd.DataFrame(got + befores(w, held.value), columns=[x.split()[0] for x in STATS.split(", ")])

    sums = split.mapInPandas(unpack, "bucket long, v long, w long, c long").groupBy("bucket", "v", "w").agg(F.sum("c").alias("c"))
    return sums.groupBy("bucket").applyInPandas(keep, STATS)


def store_befores(parts: DataFrame, size: int, folder: str) -> DataFrame:
    """Dense arrays by word id: in how many pairs a word comes last."""
    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(min(PART, size - int(key[0]) * PART), dtype=np.int64)
        for w, c in zip(rows["n_w"], rows["n_c"], strict=True):
            n[unplaned(w, "<u4")] += unplaned(c, "<u4")
        return pd.DataFrame({"part": [key[0]], "path": [save(folder, {"n": small(n)})], "k": [kinds(n[n > 0]).tolist()], "pairs": [int(n.sum())], "words": [int((n > 0).sum())]})

    return parts.groupBy("n_bucket").applyInPandas(add, "part long, path string, k array<long>, pairs long, words long")


def discounts(n: np.ndarray) -> np.ndarray:
    """D(0..3+) from the counts of counts n1..n4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.array([0.0, *[min(max(d, 0.1), k) for k, d in zip((1, 2, 3), raw, strict=True)]])


def train(docs: DataFrame) -> dict:
    """Count, store, and return the model: totals, discounts and one entry per file."""
    spark, folder = docs.sparkSession, mounted(docs.sparkSession)
    words, n, v = store_vocabulary(written(unigram_counts(docs), "kn-words"), folder)
    held = spark.sparkContext.broadcast(words)  # one entry per file of 4 * SHARD words
    found = written(store_trigrams(trigram_runs(docs, held), held, folder), "kn-trigrams")
    split = found.where("length(v) > 0").select("v", "w", "c")
    more = written(store_pairs(split, held, folder), "kn-pairs")
    parts = found.where("n_bucket is not null").select("n_bucket", "n_w", "n_c").union(more.where("n_bucket is not null").select("n_bucket", "n_w", "n_c"))
    ends = store_befores(parts, words.size, folder).collect()  # one row per PART words
    files = found.where("bucket is not null").select("bucket", "path", "pairs", "k", "kp").collect()  # one row a bucket, as in the next line
    extra, sums = more.where("bucket is not null").select("bucket", "pairs", "kp", "v", "w").collect(), {}
    for r in extra:
        for x, k in zip(unplaned(r.v, "<u8"), unplaned(r.w, "<u8").reshape(4, -1).T, strict=True):
            sums[int(x)] = sums.get(int(x), 0) + k
    add = lambda rows, c: np.sum([getattr(r, c) for r in rows], axis=0) if rows else np.zeros(4)
    one, pairs = add(ends, "k"), sum(r.pairs for r in ends)
    return {
        "N": n, "V": v, "words": words, "start": 0, "types": pairs, "kinds": (one[0], one[1], sum(r.words for r in ends) - one[0] - one[1]),
        "d3": discounts(add(files, "k")), "d2": discounts(add(files, "kp") + add(extra, "kp")), "d1": discounts(one), "sums": sums,
        "trigrams": {r.bucket: r.path for r in files}, "pairs": {r.bucket: r.pairs for r in files}, "split": {r.bucket: r.pairs for r in extra}, "ends": {r.part: r.path for r in ends},
    }


class Scorer:
    """Probabilities from the mapped arrays, for distinct trigrams in the order of their middle words."""

    def __init__(self, model: dict):
        self.m, self.words, self.read = model, model["words"], Files()

    def counts(self, path: str, at: np.ndarray) -> np.ndarray:
        """Counts at places, 0 at NONE."""
        c, over = self.read(path, "c"), self.read(path, "over")
        out = np.where(at >= 0, c[np.maximum(at, 0)], 0).astype(np.int64) if len(c) else np.zeros(len(at), np.int64)
        big = np.flatnonzero(out == 255)
        if len(big):
            out[big] = self.read(path, "more")[np.searchsorted(over, at[big])]
        return out

    def each(self, paths: dict, bucket: np.ndarray, ask: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        """The file of each bucket asked for, with the places that ask for it."""
        ask = ask[np.argsort(bucket[ask], kind="stable")]
        at = starts_of(bucket[ask])
        for i, j in zip(at[:-1], at[1:], strict=True):
            if path := paths.get(int(bucket[ask[i]])):
                yield path, ask[i:j]

    def stretch(self, path: str, keys: str, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of x among the file's keys, and the stretch of the next level that belongs to it."""
        a, at = self.read(path, keys), self.read(path, f"{keys}_at")
        i = np.searchsorted(a, x)
        i = np.where(a[np.minimum(i, len(a) - 1)] == x, i, NONE) if len(a) else np.full(len(x), NONE)
        j = np.maximum(i, 0)
        return i, np.where(i >= 0, at[j], 0).astype(np.int64), np.where(i >= 0, at[np.minimum(j + 1, len(at) - 1)], 0).astype(np.int64)

    def trigram(self, path: str, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Discounted share of (u, v, w) among what follows (u, v), and what the discounts leave."""
        _, low, high = self.stretch(path, "v", v)
        i = search(self.read(path, "u"), low, high, u)
        hit = np.flatnonzero(i >= 0)
        context, back = np.unique(i[hit], return_inverse=True)
        at = self.read(path, "u_at")
        low, high = at[context].astype(np.int64), at[context + 1].astype(np.int64)
        c = self.counts(path, search(self.read(path, "w"), low[back], high[back], w[hit]))
        sums, big, d = np.zeros((4, len(context)), dtype=np.int64), high - low > MANY, self.m["d3"]
        if big.any():
            k = np.searchsorted(self.read(path, "big"), context[big])
            sums[:, big] = [self.read(path, name)[k] for name in ("total", "k1", "k2", "k3")]
        if not big.all():
            low, sizes = low[~big], (high - low)[~big]
            first = np.cumsum(sizes) - sizes
            follow = self.counts(path, np.repeat(low - first, sizes) + np.arange(sizes.sum()))
            sums[:, ~big] = [np.add.reduceat(x.astype(np.int64), first) for x in (follow, follow == 1, follow == 2, follow > 2)]
        share, spare = np.zeros(len(u)), np.ones(len(u))
        share[hit] = np.maximum(c - d[np.minimum(c, 3)], 0) / sums[0][back]
        spare[hit] = (d[1:] @ sums[1:] / sums[0])[back]
        return share, spare

    def pair(self, path: str, v: np.ndarray, w: np.ndarray, d: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Discounted continuation count of (v, w); adds to the sums of v at ``at``: total and kinds."""
        i, low, high = self.stretch(path, "v", v)
        for k, name in enumerate(("total", "k1", "k2", "k3")):
            x = self.read(path, name)
            sums[k, at] += np.where(i >= 0, x[np.maximum(i, 0)], 0).astype(np.int64) if len(x) else 0
        c = self.counts(path, search(self.read(path, "w"), low, high, w))
        return np.maximum(c - d[np.minimum(c, 3)], 0)

    def befores(self, ids: np.ndarray) -> np.ndarray:
        """In how many pairs each of the sorted ids comes last; 0 for NONE."""
        n, part = np.zeros(len(ids), dtype=np.int64), ids // PART
        for path, at in self.each(self.m["ends"], part, np.flatnonzero(ids >= 0)):
            n[at] = self.read(path, "n")[ids[at] % PART]
        return n

    def score(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
        """P(w | u, v) of id arrays, sorted by v but for unknown ones (NONE), and ``befores`` of w. The first word of a text is told by START alone."""
        m, words = self.m, self.words
        known = np.flatnonzero(v >= 0)
        spread = words.spread(v[known])
        share3, spare3 = np.zeros(len(w)), np.ones(len(w))
        seen = (u[known] >= 0) & (v[known] != m["start"])
        ask = known[seen]
        bucket = np.full(len(w), NONE)
        bucket[ask] = words.bucket(v[ask], u[ask], (spread[0][seen], spread[1][seen]))
        for path, at in self.each(m["trigrams"], bucket, ask):
            share3[at], spare3[at] = self.trigram(path, u[at], v[at], w[at])
        held, sums = np.zeros(len(w)), np.zeros((4, len(w)), dtype=np.int64)
        one = known[spread[1] == 0]
        bucket[known] = spread[0]
        for path, at in self.each(m["pairs"], bucket, one):
            held[at] = self.pair(path, v[at], w[at], m["d2"], sums, at)
        often = spread[1] > 0  # words dealt over several buckets: few, as each has SHARD tokens or more
        two = known[often]
        for a, b in zip(at := starts_of(v[two]), at[1:], strict=False):
            sums[:, two[a:b]] = np.reshape(m["sums"].get(int(v[two[a]]), np.zeros(4, np.int64)), (4, 1))
        bucket[two] = words.bucket(v[two], np.maximum(w[two], 0), (spread[0][often], spread[1][often]))
        for path, at in self.each(m["split"], bucket, two[w[two] >= 0]):
            held[at] = self.pair(path, v[at], w[at], m["d2"], np.zeros_like(sums), at)
        total = np.maximum(sums[0], 1)
        share2 = held / total
        spare2 = np.where(sums[0] > 0, (m["d2"][1] * sums[1] + m["d2"][2] * sums[2] + m["d2"][3] * sums[3]) / total, 1.0)
        types = max(m["types"], 1)
        spare1 = sum(d * k for d, k in zip(m["d1"][1:], m["kinds"], strict=True)) / types if m["types"] else 1.0
        low = np.maximum(n - m["d1"][np.minimum(n, 3)], 0) / types + spare1 / (m["V"] + 1)
        return share3 + spare3 * (share2 + spare2 * low)


COLUMNS = (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()))


def scored(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; null text counts as empty (the end mark only).

    Without training rows all words are unknown. Repeated rows count and score each on its own. Other columns are ignored.
    The shared folder must be mounted on the workers, who map its files.
    """
    model = train(training)
    held = docs.sparkSession.sparkContext.broadcast(model)  # totals and one entry per file of about SHARD entries

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, scorer = held.value, Scorer(held.value)
        for batch in batches:
            for i, h, bounds in streams(batch.column(1), SLICE):  # what a worker holds while it scores grows with the tokens of a slice
                known, u, v, w = trigrams(h, bounds)
                ids = m["words"].ids(known)
                count = np.zeros(len(known), dtype=np.int64)
                count[ids >= 0] = m["words"].of("n", ids[ids >= 0])
                before, logp = scorer.befores(ids), np.empty(len(w))
                for a in range(0, len(w), FLUSH):
                    names, key = packed(*(x[a:a + FLUSH] for x in (v, u, w)), len(known))
                    key, again = np.unique(key, return_inverse=True)
                    kv, ku, kw = unpacked(key, names)
                    logp[a:a + FLUSH] = np.log10(scorer.score(ids[ku], ids[kv], ids[kw], before[kw]))[again]
                c = count[w]
                base = np.log10((c + 1) / (m["N"] + m["V"] + 1))
                sums = [np.diff(bounds), np.add.reduceat((c > 0).astype(np.int64), bounds[:-1]), np.add.reduceat(base, bounds[:-1]), np.add.reduceat(logp, bounds[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(bounds) - 1), *map(pa.array, sums)], ["doc_id", *(k for k, _ in COLUMNS)])

    out = T.StructType([docs.schema["doc_id"], *(T.StructField(k, t) for k, t in COLUMNS)])
    found = docs.select("doc_id", "text").mapInArrow(marks, out)
    return found.select("doc_id", "n_tokens", "n_known", F.lit(model["N"]).cast("long").alias("train_tokens"), "base_score", "score")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    return scored(docs, docs.where(~held_out)).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
