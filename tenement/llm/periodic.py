"""Periodic runs of words: Baier's grouping of suffixes gives the Lyndon arrays under both orders, Lyndon roots extended by longest common extensions give the runs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import BACK, BASE, powers, raw, slices, stir

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 24, 3


def lyndon(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place, by phase one of Baier's suffix sorter.

    Suffixes stand in groups that share a context, at first their own first letter. From the highest group down: the members of a group are done; each names the
    nearest place to its left that is not done, whose context goes on with the member's (as many times as members name it), so that place moves to a new
    group right above its old one. The context that a suffix has when its group's turn comes is its longest Lyndon prefix.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    members = [m.tolist() for m in np.split(order, cuts)] if n else []
    group = np.zeros(n, dtype=np.int64)
    group[order] = np.repeat(np.arange(len(members)), [len(m) for m in members])
    group, size = group.tolist(), [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    left, out = list(range(n + 1)), [0] * n  # place i is node i + 1; node 0 stands before the text
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        length = size[g]
        for i in own:
            out[i] = length
            left[i + 1] = i
        named: dict[int, int] = {}
        for i in own:
            k = i
            while left[k] != k:
                left[k] = k = left[left[k]]
            left[i + 1] = k
            if k:
                named[k - 1] = named.get(k - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in named.items():
            moved.setdefault((group[j], times), []).append(j)
        for old, times in sorted(moved, reverse=True):
            new, top = len(size), above[old]
            size.append(size[old] + times * length)
            members.append(moved[old, times])
            for j in members[new]:
                group[j] = new
            below.append(old)
            above.append(top)
            above[old] = below[top] = new
        members[g] = []
        g = below[g]
    return np.array(out, dtype=np.int64)


class Extensions:
    """Longest common extensions over prefix hashes, for arrays of places at a time."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.total = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(stir(codes.astype(np.uint64) + np.uint64(BASE)) * powers(BASE, self.n), out=self.total[1:])
        self.back = powers(BACK, self.n + 1)

    def of(self, a: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.total[a + size] - self.total[a]) * self.back[a]

    def _longest(self, most: np.ndarray, same: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = same(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from a and from b on, a < b."""
        return self._longest(self.n - b, lambda k: self.of(a, k) == self.of(b, k))

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before a and before b, a < b."""
        return self._longest(a, lambda k: self.of(a - k, k) == self.of(b - k, k))


def extended(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> set[tuple[int, int, int]]:
    """start, length, period of the runs of at least ``least`` words and ``times`` (two or more) periods.

    Of every run one order has its Lyndon roots as longest Lyndon words; one of them stands twice in a row. A root is not a power of a shorter word, so its length is the
    smallest period. Hashes only propose: the words of a run are compared, and where they differ the run ends.
    """
    n, found = len(codes), set()
    if n < least:
        return found
    ext = Extensions(codes)
    for way in (codes, -codes):
        p = lyndon(way)
        i = np.flatnonzero(np.arange(n) + 2 * p <= n)
        i = i[ext.of(i, p[i]) == ext.of(i + p[i], p[i])]
        q = p[i]
        start, end = i - ext.backward(i, i + q), i + q + ext.forward(i, i + q)
        enough = end - start >= np.maximum(least, times * q)
        seen = np.unique(np.stack([start, end, q])[:, enough], axis=1, return_index=True)[1]
        for s, e, k, at in zip(*(x[enough][seen].tolist() for x in (start, end, q, i)), strict=True):
            differ = np.flatnonzero(codes[s:e - k] != codes[s + k:e]) + s
            s = int(max(differ[differ < at], default=s - 1)) + 1
            e = int(min(differ[differ >= at], default=e - k)) + k
            if e - s >= max(least, times * k):
                found.add((s, e - s, k))
    return found


def stretches(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Stretches of words that hold all runs: every window of ``least // times`` words inside a run stands a second time in it, one period before or behind.

    (With w = least // times and period q: if q >= w the 3q words give 3q - w + 1 >= 2q windows, else the 3w words give 2w + 1 >= 2q.)
    """
    w = least // times
    n = len(codes) - w + 1
    if len(codes) < least:
        return []
    h, c = np.zeros(n, dtype=np.uint64), stir(codes.astype(np.uint64) + np.uint64(BASE))
    for k in range(w):
        h = h * np.uint64(BASE) + c[k:k + n]
    order = np.argsort(h)
    twin = h[order][1:] == h[order][:-1]
    again = np.zeros(n + 2, dtype=bool)
    again[order[1:][twin] + 1] = again[order[:-1][twin] + 1] = True
    edge = np.flatnonzero(again[1:] != again[:-1])
    return [(a, b + w - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b + w - 1 - a >= least]


def word_runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """start, length, period of all runs of a text's words, by start, then period."""
    if len(words) < least:
        return []
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    out = {(a + s, n, p) for a, b in stretches(codes, least, times) for s, n, p in extended(codes[a:b], least, times)}
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds behind its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for s, n, p in runs:
        keep[s + p:s + n] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Callable[[object, list[bytes]], list[bytes]] | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """key, n_words, runs (start, length, period by start, then period), collapsed (the text without the repeated periods, words joined by one blank): one row per row.

    Words are what ASCII white space parts; null texts have none. ``edit`` may change the words of a row first. Rows do not meet, so repeated rows and ties
    give equal results; other columns are ignored. A text is read whole by one task, in batches of a few MB or one text. No shuffle.
    """
    assert times >= 3 and least >= times
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i, j in slices(raw(texts)[1]):
                part, data = keys.slice(i, j - i), texts.slice(i, j - i).cast(pa.large_binary())
                n, runs, collapsed = [], [], []
                for k, x in zip(part.to_pylist(), data, strict=True):
                    words = (x.as_py() or b"").split()
                    if edit:
                        words = edit(k, words)
                    found = word_runs(words, least, times)
                    n.append(len(words))
                    runs.append([{"start": s, "length": m, "period": p} for s, m, p in found])
                    collapsed.append(b" ".join(kept_words(words, found)))
                yield pa.RecordBatch.from_arrays([part, pa.array(n, pa.int64()), pa.array(runs, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())], [key, "n_words", "runs", "collapsed"])

    return docs.select(key, F.col(text)).mapInArrow(run, f"`{key}` {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Of a tenth of the documents the words from a place on repeat with a period; a null doc_id changes nothing."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs and of the collapsed texts of all documents, and the strongest run of each.

    length/period is compared exactly: by cross products, as decimals of 38 digits hold them.
    """
    r, c = lambda k: F.col("best")[k], F.col
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted)
    longer = lambda a, b: a["length"].cast("decimal(19,0)") * b["period"].cast("decimal(19,0)") > b["length"].cast("decimal(19,0)") * a["period"].cast("decimal(19,0)")
    best = F.aggregate(c("runs"), F.get(c("runs"), 0), lambda held, x: F.when(longer(x, held), x).otherwise(held))
    lines = F.concat(F.lit(""), F.array_join(F.transform("runs", lambda x: F.concat_ws("", F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))), ""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), r("start").alias("start"), r("length").alias("length"), r("period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(c("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
