"""Importance resampling against a recomputation, CRC by arrays against zlib, the cutoff key against sorting."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tenement.llm import resample as R

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def grams(text):
    w = WORD.findall((text or "").encode().translate(LOW))
    return len(w), [zlib.crc32(b" ".join(w[i:i + k])) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def expected(docs, benchmark):
    made, s, t = [grams(x) for _, x in docs], np.zeros(10000), np.zeros(10000)
    for _, b in made:
        np.add.at(s, b, 1)
    for x in benchmark:
        np.add.at(t, grams(x)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    rows = []
    for (i, _), (n, b) in zip(docs, made, strict=True):
        w, h = sum(gain[x] for x in b), int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(b), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((k for k, r in enumerate(rows) if r[1] >= 20), key=lambda k: (-rows[k][4], rows[k][0] is None, rows[k][0]))
    rank = {k: j + 1 for j, k in enumerate(order[:5 * len(order) // 100])}
    return [(r[0], *r[2:], rank.get(k)) for k, r in enumerate(rows)]


def answered(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("block", [5, 1 << 18])
def test_buckets(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    draw = random.Random(3)
    texts = [None, "", " ", "A", "é b c", "x" * 64, "y" * 65, "z" * 200 + " a b " + "q" * 64 + " r", "日本 語" * 50, *[" ".join("".join(draw.choice("abcdeÉ,1") for _ in range(draw.randint(1, 70))) for _ in range(draw.randint(0, 30))) for _ in range(100)]]
    got, words = [[] for _ in texts], [0] * len(texts)
    for i, j, w, found in R.gram_buckets(pa.array(texts, pa.string())):
        for k in range(i, j):
            words[k] += int(w[k - i])
        for b, row in found:
            for x, r in zip(b.tolist(), row.tolist(), strict=True):
                got[i + r].append(x)
    assert [(w, sorted(g)) for w, g in zip(words, got, strict=True)] == [(n, sorted(b)) for n, b in map(grams, texts)]


def test_query_on_its_tables(spark):
    docs, bench = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = expected(list(zip(docs.doc_id.tolist(), docs.text, strict=True)), bench.text)
    assert sum(r[4] is not None for r in want) >= 5
    assert answered(R.op13_resample(spark, SF)) == sorted(map(str, want))


@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_cutoff_key(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    draw = random.Random(chunk)
    for values in ([5], [1, 1, 1, 1], [draw.randint(-9, 9) for _ in range(200)], [draw.randint(-(1 << 63), (1 << 63) - 1) for _ in range(300)], list(range(500))):
        keys = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
        down = sorted(values, reverse=True)
        for k in {1, len(values), (len(values) + 1) // 2, max(1, len(values) // 20)}:
            v = down[k - 1]
            assert R.nth_greatest(keys, k) == (v, sum(x > v for x in values), values.count(v))


def test_ties_repeats_and_odd_rows(spark):
    long = "w%d " * 40
    rows = [(None, None), (None, ""), (3, "a b"), (4, None), (5, "x " * 300_000), (6, "u" * 500_000), *[(7, "same words here " * 10)] * 400, *[(None, "same words here " * 10)] * 30, *[(i, long % tuple(range(i, i + 40))) for i in range(100, 160)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as rank", "3 as tie", "'x' as line", "4 as n_words").repartition(6)
    bench = spark.createDataFrame([("same words", 1), (None, 2)], "text string, rank int")
    assert answered(R.resampled(docs, bench)) == sorted(map(str, expected(rows, ["same words", None])))
    none = docs.limit(0)
    assert R.resampled(none, bench).count() == 0 and R.resampled(docs.where("doc_id = 3"), bench.limit(0)).first().rank is None
    assert answered(R.resampled(docs, bench.limit(0))) == sorted(map(str, expected(rows, [])))
