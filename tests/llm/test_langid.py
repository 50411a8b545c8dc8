"""Language identification: parts against plain code, the whole by held-out accuracy."""

import unicodedata
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tenement.llm import langid as L
from tenement.llm.langid import op11_language


def held(i):
    return i is not None and not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{d}/documents.parquet").set_index("doc_id")
    got = op11_language(spark, d).toPandas().set_index("doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all() and set(got.lang_pred) <= {*docs.lang.dropna(), "und"}
    assert got.held_out.tolist() == [held(i) for i in got.index]
    told = got[got.held_out].join(docs.lang.dropna(), how="inner")
    assert len(told) > 150 and (told.lang == told.lang_pred).mean() > 0.97


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_grams(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    texts = [None, "", "?!", "Ab c", "ÉTÉ  à l'été\n12x", "語" * 9, "\ud800a", "a\x00b", "İi"]
    code, at, some = L.characters(texts)

    def plain(t):
        out = [" "]
        for c in (t or "").lower():
            letter = unicodedata.category(c)[0] == "L"
            if letter or unicodedata.category((out[-1] or " ")[-1])[0] == "L":
                out.append(c if letter else " ")
        if out[-1] != " ":
            out.append(" ")
        return "".join(out)

    assert ["".join(map(chr, code[a:b])) for a, b in zip(at, at[1:], strict=False)] == [plain(t) for t in texts]
    assert some.tolist() == [False, False, False, True, True, True, True, True, True]
    counts = [Counter() for _ in texts]
    for b, row in L.gram_buckets(code, at):
        for x, r in zip(b.tolist(), row.tolist(), strict=True):
            counts[r][x] += 1
    sizes = [sum(max(0, len(p) - n + 1) for n in (1, 2, 3)) - p.count(" ") for p in map(plain, texts)]
    assert [sum(c.values()) for c in counts] == sizes


def test_document_frequencies(spark):
    texts = ["ab", "ab", "ba", None, "é"]
    df, n = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    want = np.zeros(L.BUCKETS, dtype=np.int64)
    for t in texts:
        code, at, _ = L.characters([t])
        want[list({x for b, _ in L.gram_buckets(code, at) for x in b.tolist()})] += 1
    assert n == 5 and (df == want).all()


def test_regularised_leader():
    draw = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        y = int(draw.integers(3))
        b = np.unique(np.append(draw.integers(100, 400, 12), [y, 10 + y]))
        rows.append((b, np.full(len(b), 1.0), y))
    w = L.fit(rows, 3)
    assert np.mean([int((v @ w[b] + w[-1]).argmax()) == y for b, v, y in rows]) > 0.99
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and (L.fit(rows, 3, l1=1e9) == 0).all()
    assert (w == 0).sum() <= (L.fit(rows, 3, l1=5.0) == 0).sum() < w.size and np.abs(L.fit(rows, 3, l2=100.0)).max() < np.abs(w).max()


def test_temperature():
    draw = np.random.default_rng(2)
    z = draw.normal(size=(20_000, 4))
    y = (z + draw.gumbel(size=z.shape)).argmax(axis=1)
    assert abs(L.temperature(z * 3, y) - 3) < 0.15 and L.temperature(z[:0], y[:0]) == 1.0


def test_odd_rows(spark, tmp_path):
    words = {"aa": "kala maja tuba sana ", "bb": "wrth ddwy llyn ffordd "}
    rows = [(i, words[k] * (1 + i % 4), k) for i in range(200) for k in words] + [(None, "kala maja", "aa"), (None, None, None), (900, None, "aa"), (901, "", "bb"), (902, "12 ?!", "bb"), (903, "tuba sana", None), (904, "ffordd " * 200_000, "bb"), (905, "tuba sana", "bb"), *[(906, "KALA MAJA TUBA", "aa")] * 50]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'q' as lang_pred", "7 as score", "true as held_out", "'z' as h", "1 as `key`", "'w' as source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_language(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = got.toPandas()
    at = lambda i: got[got.doc_id == i].lang_pred.tolist()
    assert len(got) == len(rows) and at(900) == at(901) == at(902) == ["und"] and at(903) == at(905) == ["aa"] and at(904) == ["bb"] and set(at(906)) == {"aa"} and len(at(906)) == 50
    none = got[got.doc_id.isna()]
    assert sorted(none.lang_pred) == ["aa", "und"] and not none.held_out.any()
    assert got.score.between(0, 1).all() and (got[got.lang_pred == "und"].score == 0).all()
    again = op11_language(spark, str(tmp_path)).toPandas()
    key = ["doc_id", "lang_pred", "score"]
    assert again[key].sort_values(key).reset_index(drop=True).equals(got[key].sort_values(key).reset_index(drop=True))
    # Nothing to learn from, and nothing at all.
    docs.withColumn("lang", docs.text.substr(0, 0).cast("string")).where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op11_language(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "mute" / "documents.parquet"))
    assert [r.lang_pred for r in op11_language(spark, str(tmp_path / "mute")).collect()] == ["und"]
