"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, fitted by follow-the-regularised-leader with elastic-net penalties, then a temperature."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table
from .tokens import raw, slices, stir

BUCKETS, ORDERS = 1 << 16, 3
#: Bounds of the fit: learned rows of each language and of all, features of one row (its heaviest).
PER_LANG, ROWS, FEATURES = 1000, 8000, 4096
#: Chosen on fold 1 of the learned rows (crc32 mod 4), see README; RATE, L1 and L2 are of the regularised leader.
SCALE, MASS, RATE, L1, L2, EPOCHS = 50.0, 500.0, 0.2, 0.5, 1.0, 3
#: Characters of a block of n-grams, documents whose distinct buckets are counted at a time.
BLOCK, FLAGS = 1 << 20, 64
NONE = "und"
_letters = None


def letters() -> np.ndarray:
    """Of every code point whether it is a letter (general category L*)."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lower-cased texts, each run of others than letters as one blank, with a blank before and behind each text; the n + 1 offsets; whether a text has a letter."""
    low = [f" {(t or '').lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in low], out=ends[1:])
    letter = letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[ends[:-1]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[ends]
    n = np.concatenate([[0], np.cumsum(letter)])[ends]
    return np.where(letter, code, np.uint32(32))[keep], at, np.diff(n) > 0


def gram_buckets(code: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and texts of all runs of 1 to ORDERS characters, a block at a time; the blank alone tells nothing and is none."""
    for s in range(0, len(code), BLOCK):
        part = code[s:s + BLOCK + ORDERS - 1].astype(np.uint64)
        text = np.searchsorted(at, np.arange(s, s + len(part)), "right") - 1
        own, h = min(BLOCK, len(code) - s), np.zeros(len(part), dtype=np.uint64)
        for n in range(1, ORDERS + 1):
            m = min(own, len(part) - n + 1)
            if m <= 0:
                break
            h = h[:len(part) - n + 1] * np.uint64(0x110001) + part[n - 1:]
            ok = text[:m] == text[n - 1:n - 1 + m]
            if n == 1:
                ok &= part[:m] != 32
            yield (stir(h[:m][ok] + np.uint64(n)) >> np.uint64(48)).astype(np.int64) % BUCKETS, text[:m][ok]


def _parts(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    for i, j in slices(raw(column)[1], BLOCK):
        yield i, j, column.slice(i, j - i).to_pylist()


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Texts that hold each bucket, and all texts. A task sends one row per bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, texts in _parts(batch.column(0)):
                for k in range(0, len(texts), FLAGS):
                    code, at, _ = characters(texts[k:k + FLAGS])
                    held = np.zeros((len(at) - 1, BUCKETS), dtype=bool)
                    for b, row in gram_buckets(code, at):
                        held[row, b] = True
                    total += held.sum(axis=0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["bucket", "n"])

    out, n = np.zeros(BUCKETS, dtype=np.int64), 0
    for r in docs.select(F.col(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r.bucket < 0:
            n = r.n
        else:
            out[r.bucket] = r.n
    return out, n


def vectors(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """lang, h, b, v: the FEATURES heaviest TF-IDF values of every text, as shares of all of its values and MASS, times SCALE: a short text tells less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, texts in _parts(batch.column(2)):
                for t in texts:
                    code, at, _ = characters([t])
                    tf = np.zeros(BUCKETS)
                    for b, _ in gram_buckets(code, at):
                        tf += np.bincount(b, minlength=BUCKETS)
                    v = tf * idf
                    best = np.flatnonzero(v)
                    if len(best) > FEATURES:
                        best = np.sort(best[np.argsort(-v[best], kind="stable")[:FEATURES]])
                    out.append((best, SCALE * v[best] / (v.sum() + MASS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b for b, _ in out], pa.list_(pa.int64())), pa.array([v for _, v in out], pa.list_(pa.float64()))], ["lang", "h", "b", "v"])

    return rows.select("lang", "h", "text").mapInArrow(run, "lang string, h long, b array<long>, v array<double>")


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, rate: float = RATE, l1: float = L1, l2: float = L2, epochs: int = EPOCHS) -> np.ndarray:
    """Weights [BUCKETS + 1, classes] (the last row is the bias) of the follow-the-regularised-leader updates, one row after the other; most weights are exactly zero."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def at(b: np.ndarray) -> np.ndarray:
        zb = z[b]
        return np.where(np.abs(zb) <= l1, 0.0, -(zb - np.sign(zb) * l1) / ((1 + np.sqrt(n[b])) / rate + l2))

    for _ in range(epochs):
        for b, v, y in rows:
            b, v = np.append(b, BUCKETS), np.append(v, 1.0)
            w = at(b)
            p = softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p
            z[b] += g - (np.sqrt(n[b] + g * g) - np.sqrt(n[b])) / rate * w
            n[b] += g * g
    return at(np.arange(BUCKETS + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature from 1/20 to 20 under which the logits have the least log loss, to a thousandth; 1 without rows."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()
    a, b, g = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    while b - a > 1e-3:
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class Model:
    """``langs`` in order; of every bucket its IDF and the IDF times the weights of each language over the temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.langs, self.bias = langs, weights[-1] / heat
        self.share = np.column_stack([idf, idf[:, None] * weights[:-1] * (SCALE / heat)])

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its probability; ``und`` and 0 where a text has no letter or nothing was learned."""
        code, at, some = characters(texts)
        sums = np.zeros((len(texts), self.share.shape[1]))
        for b, row in gram_buckets(code, at):
            for k in range(sums.shape[1]):
                sums[:, k] += np.bincount(row, self.share[b, k], len(texts))
        if not self.langs:
            return [NONE] * len(texts), np.zeros(len(texts))
        p = softmax(sums[:, 1:] / (sums[:, :1] + MASS) + self.bias)
        best = p.argmax(axis=1)
        return [self.langs[k] if ok else NONE for k, ok in zip(best, some, strict=True)], np.where(some, p.max(axis=1), 0.0)


def train(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", **how: float) -> Model:
    """A model of the rows of ``docs`` with a language, a text and a key.

    Document frequencies cover all of these rows. Weights are fitted on a sample: of every language the rows whose key hashes lowest, about PER_LANG (fewer if there are so many languages
    that ROWS would be passed), each as at most FEATURES numbers; a fifth of it sets the temperature. Only these numbers come to the driver.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("text"), F.col(key).alias("key")).where("lang is not null and text is not null and key is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    df, n = document_frequencies(rows)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    idf[df == 0] = 0.0
    quota = max(1, min(PER_LANG, ROWS // len(langs)))
    # Rows whose hash lies in the lowest quota/n-th of all hashes.
    share = rows.sparkSession.createDataFrame([(k, int(min(1.0, quota / counts[k]) * (1 << 64)) - (1 << 63)) for k in langs if quota < counts[k]] or [("", 0)], "lang string, upto long")
    sample = rows.join(F.broadcast(share), "lang", "left").where("upto is null or h < upto")
    got = [(r.lang, r.h, np.array(r.b, dtype=np.int64), np.array(r.v)) for r in vectors(sample, idf).collect()]
    # A key that stands in many rows counts once per feature vector.
    got = list({(k, h, b.tobytes(), v.tobytes()): (k, h, b, v) for k, h, b, v in got}.values())
    got.sort(key=lambda r: (stir(np.array([r[1]]).view(np.uint64))[0], r[0], r[2].tobytes(), r[3].tobytes()))
    place = {k: i for i, k in enumerate(langs)}
    learned = [(b, v, place[k]) for i, (k, _, b, v) in enumerate(got) if i % 5]
    held = [(b, v, place[k]) for i, (k, _, b, v) in enumerate(got) if not i % 5]
    w = fit(learned, len(langs), **how)
    logits = np.array([v @ w[b] + w[-1] for b, v, _ in held]).reshape(-1, len(langs))
    return Model(langs, idf, w, temperature(logits, np.array([y for *_, y in held], dtype=np.int64)))


def predicted(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", *keep: Column) -> DataFrame:
    """key, ``keep``, lang_pred and score of every row, null and empty texts too; whole texts, no shuffle."""
    rows = docs.select(F.col(text), F.col(key), *keep)
    schema = rows.drop(rows.columns[0]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, _, texts in _parts(batch.column(0)):
                a, b = model.score(texts)
                langs += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], [*schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", lang_pred string, score double")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. Rows of a null doc_id are scored like others, not learned from and not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return predicted(docs, train(docs.where(~held)), "doc_id", "text", held.alias("held_out")).select("doc_id", "held_out", "lang_pred", "score")
