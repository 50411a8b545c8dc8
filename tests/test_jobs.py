"""Streams over several micro-batches, upserts against a plain fold, archives and export jobs."""

import datetime
import random

import pytest

from tenement.operators.upsert import upsert_patches
from tenement.plans.export import Job, options
from tenement.sources.keyed import KeyedTable
from tenement.streaming import jobs

SCHEMA = "id string, day int, seq bigint, status int, a int, b string, present array<string>"
STATE = "id string, status int, a int, b string, seq bigint"


def fold(rows, keep_deal):
    """One item after the other."""
    held = {}
    for r in sorted(rows, key=lambda r: r[2]):
        key = r[0] if keep_deal else (r[0], r[1])
        old = held.get(key, {"status": None, "a": None, "b": None})
        new = dict(old) | {f: v for f, v in (("a", r[4]), ("b", r[5])) if f in r[6]}
        new["status"] = 2 if keep_deal and r[3] == 1 and old["status"] == 2 else r[3]
        held[key] = new
    return held


def drawn(seed, n=200):
    draw = random.Random(seed)
    return [(f"k{draw.randint(0, 9)}", draw.randint(1, 3), i, draw.randint(0, 2), draw.choice([None, 1, 2]), draw.choice([None, "x"]), draw.choice([[], ["a"], ["b"], ["a", "b"]])) for i in range(n)]


@pytest.mark.parametrize("cut", [0, 70, 200])
def test_upsert_is_a_fold(spark, cut):
    rows = drawn(cut)
    every = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], STATE)
    base = upsert_patches(none, every.where(f"seq < {cut}"), ["id"], "seq", "status", ["a", "b"], "present")
    got = upsert_patches(base, every.where(f"seq >= {cut}"), ["id"], "seq", "status", ["a", "b"], "present").collect()
    assert {r.id: {"status": r.status, "a": r.a, "b": r.b} for r in got} == fold(rows, True)


def tables(spark, path):
    latest = KeyedTable(spark, f"{path}/latest", STATE, ["id"], 8)
    return latest, KeyedTable(spark, f"{path}/history", "id string, day int, status int, a int, b string, seq bigint", ["id", "day"], 2, by=["day"])


def test_stream_in_batches(spark, tmp_path):
    rows = drawn(5)
    for i in range(4):
        spark.createDataFrame(rows[i * 50:(i + 1) * 50], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        latest, history = tables(spark, tmp_path)
        items = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        q = jobs.stream_upsert(items, str(tmp_path / "state"), latest, history, "id", "day", "seq", "status", ["a", "b"], "present")
        q.awaitTermination()
        last = q.lastProgress["batchId"]
    assert last == 3 and latest.versions() == [2, 3]
    assert {r.id: {"status": r.status, "a": r.a, "b": r.b} for r in latest.read().collect()} == fold(rows, True)
    assert {(r.id, r.day): {"status": r.status, "a": r.a, "b": r.b} for r in history.read().collect()} == fold(rows, False)
    assert {r.id: {"status": r.status, "a": r.a, "b": r.b} for r in latest.read(2).collect()} == fold(rows[:150], True)


def merge(table, token, rows, keep=2):
    return table.merge(token, table.spark.createDataFrame(rows, SCHEMA), lambda base, new: upsert_patches(base, new, table.key, "seq", "status", ["a", "b"], "present", keep_deal=len(table.key) == 1), keep)


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_a_batch_of_one_key_writes_one_bucket(spark, tmp_path):
    latest, history = tables(spark, tmp_path)
    rows = drawn(6)
    merge(latest, "a", rows)
    merge(history, "a", rows)
    before, days = files_of(tmp_path / "latest"), files_of(tmp_path / "history")
    assert len({f.rsplit("/", 1)[0] for f in before}) > 3
    one = [("k3", 2, 1000, 1, 7, "y", ["a"])]
    assert merge(latest, "b", one) == merge(history, "b", one) == 1
    new = files_of(tmp_path / "latest")
    assert len(set(new) - set(before)) == 1 and set(before) <= set(new)
    assert {f.split("bucket=")[1].split("-")[0] for f in set(files_of(tmp_path / "history")) - set(days)} == {"2"}
    assert {r.id: {"status": r.status, "a": r.a, "b": r.b} for r in latest.read().collect()} == fold(rows + one, True)
    # What only the first version held goes with it; buckets of the first that still hold stay.
    merge(latest, "c", [("k3", 2, 1001, 0, 8, "y", ["a"])])
    held = latest.manifest(2)["held"]
    assert latest.versions() == [1, 2] and sorted(set(held.values())) == [0, 2]
    assert len([f for f in files_of(tmp_path / "latest") if f.startswith("data/0")]) == len(before) - 1


def test_a_batch_counts_once(spark, tmp_path):
    rows = drawn(7)
    latest, _ = tables(spark, tmp_path)
    merge(latest, "a", rows[:100])
    merge(latest, "b", rows[100:])
    want = sorted(latest.read().collect())
    assert merge(latest, "b", rows[100:]) == 1 and sorted(latest.read().collect()) == want
    # Killed before the manifest: the version is not there, and the next run writes its folder again.
    manifest = tmp_path / "latest" / "versions" / "1"
    manifest.unlink()
    again, _ = tables(spark, tmp_path)
    assert again.newest() == 0 and {r.id: {"status": r.status, "a": r.a, "b": r.b} for r in again.read().collect()} == fold(rows[:100], True)
    assert merge(again, "b", rows[100:]) == 1 and sorted(again.read().collect()) == want
    assert merge(again, "c", []) == 2 and sorted(again.read().collect()) == want


def test_odd_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id string, day date, status int, a int, b string, seq bigint", ["id", "day"], 3, by=["day"])
    assert table.read().count() == 0 and table.newest() == -1
    day = datetime.date(2024, 2, 1)
    rows = spark.createDataFrame([(None, None, 1, 0, 1, "x", None), ("", day, 2, 1, None, None, ["a"]), ("a/b=c %", day, 3, 2, 5, "z", ["a", "b"]), ("a/b=c %", day, 3, 2, 5, "z", ["a", "b"])], "id string, day date, seq bigint, status int, a int, b string, present array<string>")
    def fold_in(base, new):
        return upsert_patches(base, new, ["id", "day"], "seq", "status", ["a", "b"], keep_deal=False)

    table.merge("1", rows, fold_in)
    other = KeyedTable(spark, str(tmp_path / "t"), table.schema, ["id", "day"], 99, by=["day"])
    assert other.buckets == 3 and sorted(("-" if r.id is None else r.id, r.day or day, r.status) for r in other.read().collect()) == [("", day, 1), ("-", day, 0), ("a/b=c %", day, 2)]


def test_job_periods():
    day = datetime.date
    assert [p[0] for p in Job(periodic=True).periods(day(2024, 12, 31))] == ["202412", "2024Q4", "2024"]
    assert [p[0] for p in Job(periodic=True).periods(day(2024, 2, 29))] == ["202402"] and Job(periodic=True).periods(day(2024, 2, 28)) == []
    name, job = options(["orders", "--start", "2024-02-01", "--end", "2024-01-01", "--enum", "--digits", "--regions", "a,b"])
    assert name == "orders" and job.enum and not job.letters and job.regions == ("a", "b") and job.periods(day(2024, 1, 1))[0][1:] == (day(2024, 1, 1), day(2024, 2, 1))


def test_parser_errors(spark):
    from tenement.extract.html import extract_details

    def picky(html):
        if "bad" in html:
            raise ValueError(html)
        return html, None, None, [], 0, []

    pages = spark.createDataFrame([(1, "<p>x"), (2, "bad"), (3, None), (4, "")], "page_id long, html string")
    got = {r.page_id: r for r in extract_details(pages, parser=picky).collect()}
    assert set(got) == {1, 2, 4} and got[2].parse_errors == ["ValueError"] and got[1].title == "<p>x"
    assert {r.page_id: r.parse_errors for r in extract_details(pages).collect()} == {i: ["title", "heading"] for i in (1, 2, 4)}


def test_seen_once_in_a_run(spark, tmp_path):
    """State ends with its timer: an id of an ended run is let through again, and state stays bounded."""
    at = lambda day, hour=0: datetime.datetime(2024, 1, day, hour)
    batches = [
        [("a", 1, at(1, 2), "late"), ("a", 1, at(1, 1), "first"), ("b", 1, at(1), "first"), ("c", None, at(1), "none"), *[(f"x{i}", 1, at(1), "first") for i in range(40)]],
        [("a", 1, at(1, 5), "again"), ("a", 2, at(1, 6), "next run"), ("a", 1, at(1, 7), "old run")],
        [("a", 2, at(8), "again"), ("b", 2, at(8), "first"), ("d", 9, at(8), "first")],
        [("d", 9, at(8, 1), "again"), ("e", 9, at(8, 1), "first")],
        [("b", 1, at(9), "old run"), ("x3", 1, at(9), "its run has ended")],
    ]
    states = []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id string, run long, ts timestamp, note string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        items = spark.readStream.schema("id string, run long, ts timestamp, note string").parquet(str(tmp_path / "in"))
        with jobs.rocksdb_state(spark):
            q = jobs.run(jobs.unseen(items, "id", "run", "ts", datetime.timedelta(days=2)), str(tmp_path / "state"), lambda df, batch: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch}"))
        q.awaitTermination()
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.id, r.run, r.note) for r in spark.read.parquet(str(tmp_path / "out")).collect() if not r.id.startswith("x"))
    assert got == [("a", 1, "first"), ("a", 2, "next run"), ("b", 1, "first"), ("b", 2, "first"), ("d", 9, "first"), ("e", 9, "first")]
    x3 = [r.note for r in spark.read.parquet(str(tmp_path / "out")).where("id = 'x3'").collect()]
    assert sorted(x3) == ["first", "its run has ended"]
    assert states[0] > 40 and states[-1] < 20
