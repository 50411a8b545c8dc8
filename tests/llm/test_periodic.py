"""Runs of words against a plain search over all periods, digests against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd

from tenement.llm.periodic import Extensions, lyndon, op12_periodic, periodic_runs, word_runs

SF = "/root/testdata/sf0.001"


def plain_lyndon(c):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(k for k in range(1, len(c) - i + 1) if is_lyndon(c[i:i + k])) for i in range(len(c))]


def plain_runs(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            part = w[i:j + q]
            if len(part) >= max(least, times * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_arrays():
    draw = random.Random(1)
    for _ in range(400):
        c = [draw.randint(0, draw.choice([1, 2, 4])) for _ in range(draw.randint(0, 14))]
        assert lyndon(np.array(c, dtype=np.int64)).tolist() == plain_lyndon(c)


def test_runs_of_random_words():
    draw = random.Random(2)
    for _ in range(600):
        w, letters = [], draw.choice([1, 2, 3])
        while len(w) < draw.randint(10, 120):
            u = [bytes([97 + draw.randint(0, letters)]) for _ in range(draw.randint(1, 9))]
            w += (u * draw.randint(1, 6))[:draw.randint(1, 40)]
        least, times = draw.choice([(24, 3), (6, 3), (9, 3), (8, 4)])
        assert word_runs(w, least, times) == plain_runs(w, least, times)


def test_structured_words():
    fib, other = ["a"], ["a", "b"]
    while len(other) < 800:
        fib, other = other, other + fib
    thue = [bin(i).count("1") % 2 for i in range(1024)]
    for w in (other, thue, thue * 3, [0] * 500, list(range(100)) * 4, [0] * 23, [0] * 24, list(range(8)) * 3, list(range(9)) * 2 + list(range(8))):
        w = [str(x).encode() for x in w]
        assert word_runs(w) == plain_runs(w)


def test_false_hash_matches_are_cut(monkeypatch):
    w = [b"x", *[str(i % 5).encode() for i in range(40)], b"y", b"z", *[str(i % 7).encode() for i in range(60)]]
    want = plain_runs(w)
    monkeypatch.setattr(Extensions, "forward", lambda self, a, b: self.n - b)
    monkeypatch.setattr(Extensions, "backward", lambda self, a, b: a)
    assert word_runs(w) == want == [(1, 40, 5), (43, 60, 7)]


def expected(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {i for s, m, p in runs for i in range(s + p, s + m)}
    top = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    best = (*top[0], 1000 * top[0][1] // top[0][2]) if top else (None,) * 4
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *best, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def answered(df):
    return [tuple(None if isinstance(x, float) and pd.isna(x) else x for x in r) for r in map(tuple, df.collect())]


def test_query_on_its_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = {r[0]: r for r in answered(op12_periodic(spark, SF))}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 10
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        assert got[i] == expected(i, t)


def test_edge_rows(spark, tmp_path):
    ten = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(1, None, "a"), (1, "", "b"), (None, "a " * 30, "c"), (ten, "one", "d"), (ten, "", "e"), (7, "a b c " * 8, "f"), (7, "a b c " * 8, "f"), (8, "　 x y " * 12 + "a\x0b" * 24, "g"), (9, "w " * 200_000, "h"), (11, "A a " * 12, "i")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").selectExpr("doc_id", "text", "runs", "1 as n_words", "2 as best").write.parquet(str(tmp_path / "documents.parquet"))
    got = answered(op12_periodic(spark, str(tmp_path)))
    short = [r for r in rows if r[0] != 9]
    assert sorted(map(str, (r for r in got if r[0] != 9))) == sorted(str(expected(*r[:2])) for r in short)
    assert [r[1:6] for r in got if r[0] == 9] == [(1, 0, 200_000, 1, 200_000_000)]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op12_periodic(spark, str(tmp_path / "none")).count() == 0


def test_collapsed_texts(spark):
    rows = spark.createDataFrame([(1, "x " + "spam ham " * 20 + "y  z"), (2, "Ä  b\tc")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(rows).collect()}
    assert got[1].collapsed == "x spam ham y z" and [tuple(r) for r in got[1].runs] == [(1, 40, 2)] and got[1].n_words == 43
    assert got[2].collapsed == "Ä b c" and got[2].runs == []
