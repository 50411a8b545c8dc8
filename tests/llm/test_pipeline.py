"""The pipeline against its stages' plain versions, on planted rows."""

import hashlib
from pathlib import Path

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=120):
    """Readable words, the same for the same seed."""
    return " ".join("".join(chr(97 + b % 26) for b in hashlib.md5(f"{seed}-{i}".encode()).digest()[:3 + i % 6]) for i in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("sf")
    item = " ".join(f"item{i}" for i in range(14))
    good = [(i, prose(i), "en", f"s{i % 3}", 0) for i in range(40)]
    rows = [*good, (100, prose(1), "en", "s0", 0), (101, prose(2).replace(prose(2).split()[60], "changed"), "en", "s1", 0), (102, prose(50, 60) + " " + item + " " + prose(51, 60), "en", "s1", 0),
            (103, prose(52) + " write to some.body@host.org now", None, None, 0), (104, None, None, None, 0), (104, None, None, None, 0), (None, prose(53), "en", "s2", 0), (3, prose(3), "en", "s0", 0)]
    junk = [(200 + i, "!!! ### %%% " * 30, "en", "s2", 0) for i in range(20)]
    spark.createDataFrame(rows + junk, SCHEMA).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, 0) for i in range(40)] + [(200 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return str(base)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, folder)
        if name != "mixing":
            assert out.columns == docs.columns
        before = spark.createDataFrame(out.collect(), out.schema)
        after[name] = before.collect()
    ids = {name: sorted(r.doc_id if r.doc_id is not None else -1 for r in rows) for name, rows in after.items()}
    assert not any(i >= 200 for i in ids["quality"]) and set(range(40)) <= set(ids["quality"])
    assert ids["near_dedup"].count(3) == 1 and not {100, 101} & set(ids["near_dedup"]) and set(range(40)) <= set(ids["near_dedup"])
    assert set(ids["near_dedup"]) - set(ids["decontaminate"]) == {102} & set(ids["near_dedup"])
    text = {r.doc_id: r.text for r in after["pii"]}
    if 103 in text:
        assert text[103].endswith("write to [EMAIL] now")
    assert ids["pii"] == ids["decontaminate"] == ids["mixing"]
    assert all(r.taken <= 3 * r.size for r in after["mixing"]) and all(r.size == len((text[r.doc_id] or "").split()) for r in after["mixing"] if r.doc_id is not None)


def test_run_and_empty(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() >= 40
    stages = Path(out.inputFiles()[0].removeprefix("file://")).parents[1]
    assert [p.name for p in stages.iterdir()] == ["4_mixing"]  # what the other stages wrote is gone
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_takes_simhash_anchors(spark, monkeypatch):
    from tenement.llm import neardup

    words = prose(70, 400).split()
    texts = {1: words, 2: [*words[:-1], "other"], 3: [*words[:-1], "third"], 4: prose(71, 400).split(), 5: words * 2}
    texts = {k: " ".join(x) for k, x in texts.items()}
    prints = {k: neardup.majority(neardup.shingles(t)) for k, t in texts.items()}
    apart = lambda a, b: ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count()
    assert apart(1, 2) <= 2 and apart(1, 3) <= 2 and apart(1, 4) > 2
    monkeypatch.setattr(neardup, "BANDS", 0)  # no band proposes anything
    got = {(r.u, r.v) for r in neardup.similar_links(spark.createDataFrame(list(texts.items()), "key long, text string")).collect()}
    linked = {x for pair in got for x in pair}
    assert {1, 2, 3} <= linked and 4 not in linked
