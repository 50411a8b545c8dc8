"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, table

# WINDOW and the rate of fit were chosen on one of the training folds (crc32 mod 5 = 1), never on held-out rows.
BUCKETS, DIM, WINDOW = 1 << 15, 8, 2
# Scripts without blanks (kana, Han, Thai, Lao, Burmese, Khmer) give their characters singly.
SINGLE = "\u3040-\u30ff\u3400-\u9fff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
WORD = re.compile(rf"[{SINGLE}]|[^\W_{SINGLE}]+(?:'[^\W_{SINGLE}]+)?")


def pieces(word: str) -> set[int]:
    """Buckets of the word and its 3- to 5-character pieces."""
    w = f"<{word}>"
    parts = (w[i:i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1))
    return {zlib.crc32(w.encode()) % BUCKETS} | {zlib.crc32(p.encode()) % BUCKETS for p in parts}


def subwords(word: str) -> np.ndarray:
    return np.array(sorted(pieces(word)), dtype=np.int64)


def spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows over n words, which overlap by half; one empty window if there are none."""
    a = np.arange(0, max(1, n - WINDOW // 2), WINDOW // 2)
    return a, np.minimum(a + WINDOW, n)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Logits(dict):
    """A word's share of the difference of the two class scores, worked out once for each word."""

    def __init__(self, share: list[float]):
        super().__init__()
        self.share = share

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        at = sorted(pieces(word))
        v = sum([self.share[b] for b in at]) / len(at)
        if len(word) <= 64:  # longer ones are worked out each time, so that memory stays bounded
            self[word] = v
        return v


class Model:
    """Word vectors are means of subword vectors, a window's vector the mean of its words', a text scores as its most toxic window."""

    def __init__(self, emb: np.ndarray, out: np.ndarray, bias: np.ndarray):
        self.emb, self.out, self.bias = emb, out, bias
        self.logits = Logits((emb @ (out[:, 1] - out[:, 0])).tolist())

    def score(self, text: str | None) -> float:
        words, base = words_of(text), float(self.bias[1] - self.bias[0])
        total = np.zeros(len(words) + 1)
        np.cumsum(np.fromiter(map(self.logits.__getitem__, words), dtype=float, count=len(words)), out=total[1:])
        a, b = spans(len(words))
        z = ((total[b] - total[a]) / np.maximum(b - a, 1)).max() + base
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


class Bags:
    """Training texts as arrays: tokens, the subwords of every distinct word, and windows with the text they belong to."""

    def __init__(self, texts: list[str | None]):
        ids: dict[str, int] = {}
        parts = [np.array([ids.setdefault(w, len(ids)) for w in words_of(t)], dtype=np.int64) for t in texts]
        self.tokens, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        subs = [subwords(w) for w in ids]
        self.n_subs = np.array([len(s) for s in subs], dtype=np.int64)
        self.subs = np.concatenate(subs) if subs else np.zeros(0, dtype=np.int64)
        self.at_subs = np.cumsum(self.n_subs) - self.n_subs
        cuts, base = [spans(n) for n in sizes], np.cumsum(sizes) - sizes
        self.start = np.concatenate([a + o for (a, _), o in zip(cuts, base, strict=True)])
        self.end = np.concatenate([b + o for (_, b), o in zip(cuts, base, strict=True)])
        self.n_windows = np.array([len(a) for a, _ in cuts])
        self.first = np.cumsum(self.n_windows) - self.n_windows
        self.owner = np.repeat(np.arange(len(texts)), self.n_windows)
        self.size = np.maximum(self.end - self.start, 1)

    def presence(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic and clean texts that hold each word."""
        text_of = np.repeat(np.arange(len(y)), np.diff(np.append(self.start[self.first], len(self.tokens))))
        pair = np.unique(np.stack([self.tokens, text_of]), axis=1)
        return (np.bincount(pair[0], y[pair[1]], len(self.n_subs)), np.bincount(pair[0], 1 - y[pair[1]], len(self.n_subs)))

    def words(self, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into picks, word) of every word in the picked windows."""
        at = self.start[picks][:, None] + np.arange(WINDOW)
        inside = at < self.end[picks][:, None]
        return np.nonzero(inside)[0], self.tokens[at[inside]]


def fit(texts: list[str | None], y: np.ndarray, epochs: int = 40, rate: float = 0.1, seed: int = 3) -> Model:
    """Embeddings and softmax together, by adaptive gradient steps on windows: a toxic text teaches through its most toxic window, a
    clean one through its most toxic and one random window. Labels are not always right, so a toxic text that has no window near the toxic
    class counts less, by that window's chance. Subwords of words that only toxic texts hold start apart from the others."""
    rng = np.random.default_rng(seed)
    emb, out, bias = rng.normal(0, 0.05, (BUCKETS, DIM)), np.zeros((DIM, 2)), np.array([1.5, -1.5])
    if len(y) == 0 or y.min() == y.max():
        return Model(emb, out, np.array([0.0, 0.0]) if len(y) == 0 else np.array([-3.0, 3.0]) if y[0] == 1 else np.array([3.0, -3.0]))
    out[0] = [-2.0, 2.0]
    bags = Bags(texts)
    if len(bags.tokens) == 0:
        return Model(emb, out * 0, np.log([(1 - y).mean(), y.mean()]))
    toxic, clean = bags.presence(y)
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / (len(y) - y.sum() + 1))
    hits = np.bincount(bags.subs, np.repeat(toxic + clean, bags.n_subs), BUCKETS)
    lift = np.bincount(bags.subs, np.repeat(odds * (toxic + clean), bags.n_subs), BUCKETS)
    emb[:, 0] += lift / np.maximum(hits, 1) * np.minimum(hits, 5) / 5
    held = {"emb": np.full(emb.shape, 1e-8), "out": np.full(DIM, 1e-8), "bias": 1e-8}
    for _ in range(epochs):
        vectors = np.add.reduceat(emb[bags.subs], bags.at_subs) / bags.n_subs[:, None]
        d = out[:, 1] - out[:, 0]
        total = np.concatenate([[0.0], np.cumsum((vectors @ d)[bags.tokens])])
        z = (total[bags.end] - total[bags.start]) / bags.size + bias[1] - bias[0]
        high = np.flatnonzero(z == np.maximum.reduceat(z, bags.first)[bags.owner])
        worst = high[np.unique(bags.owner[high], return_index=True)[1]]
        picks = np.concatenate([worst, (bags.first + rng.integers(bags.n_windows))[y == 0]])
        g = 1 / (1 + np.exp(-np.clip(z[picks], -50, 50))) - np.concatenate([y, np.zeros(int((y == 0).sum()))])
        g[:len(y)][y == 1] *= np.minimum(1, 2 / (1 + np.exp(-np.clip(z[worst][y == 1], -50, 50))))
        at, words = bags.words(picks)
        pull = np.bincount(words, (g / bags.size[picks])[at], len(bags.n_subs))
        grad_emb = np.bincount(bags.subs, np.repeat(pull / bags.n_subs, bags.n_subs), BUCKETS)[:, None] * d
        grad_out, grad_bias = pull @ vectors, g.sum()
        held["emb"] += grad_emb**2
        held["out"] += grad_out**2
        held["bias"] += grad_bias**2
        emb -= rate * grad_emb / np.sqrt(held["emb"])
        step = 0.5 * rate * np.stack([-grad_out, grad_out], axis=1) / np.sqrt(held["out"])[:, None]
        out -= step
        bias -= 0.5 * rate * np.array([-grad_bias, grad_bias]) / np.sqrt(held["bias"])
    return Model(emb, out, bias)


def train(docs: DataFrame, labels: DataFrame, bound: int = 1000, most_bytes: int = 64 << 20) -> Model:
    """Fit on at most ``bound`` different labelled texts of each class and ``most_bytes`` of text, those of least hashed id, of folds other than 0 (mod 5)."""
    some = labels.where("toxic is not null and doc_id is not null").where(fold(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    some = some.where("toxic = 1").orderBy(*order).limit(bound).union(some.where("toxic = 0").orderBy(*order).limit(bound))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id").withColumn("_h", F.xxhash64("doc_id", "text")).dropDuplicates(["doc_id", "_h"])
    rows = rows.orderBy("_h").limit(2 * bound)
    upto = F.sum(F.octet_length("text")).over(Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, 0))  # over at most 2 * bound rows
    rows = rows.withColumn("_b", upto).where(F.col("_b") <= most_bytes).select("doc_id", "text", "toxic").toPandas().sort_values(["doc_id", "text"], kind="stable")
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row. Null text scores as empty; repeated rows score alike; further columns are ignored; without labels every score is 0.5."""
    model = train(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast((model.emb.astype("float32"), model.out, model.bias))  # fixed size: BUCKETS x DIM

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Model(*held.value)
        for s in texts:
            yield pd.Series([m.score(t) for t in s], dtype="float64")

    return docs.select("doc_id", score("text").alias("score"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
