"""Stored ids and codes, raw texts, the archive of days, regions of odd texts, and what export options do."""

import ast
import datetime
import json

import pytest
from pyspark.sql import functions as F

from tenement.functions.listing import literal_json, region_names
from tenement.operators.dimension import extended_codes, get_or_create, id_table, spellings, with_ids
from tenement.operators.fields import Field, Rendering, grouped, project
from tenement.operators.upsert import raw_table, upsert_raw
from tenement.sources.archive import add_hot, archive_days, hot_days, read_hot


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "author string")


def test_ids_are_given_once(spark, tmp_path):
    ids = id_table(spark, str(tmp_path / "ids"), 4)
    get_or_create(ids, names(spark, "a", "b", "b", None, ""), "author", "one")
    first = {r.truth: r.id for r in ids.read().collect()}
    assert set(first) == {"a", "b", ""} and len(set(first.values())) == 3
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "ids" / "data").rglob("*.parquet")}
    get_or_create(ids, names(spark, "b", "c"), "author", "two")
    get_or_create(ids, names(spark, "b", "c"), "author", "two")
    get_or_create(ids, names(spark, "a", "c"), "author", "three")
    now = {r.truth: (r.id, r.since) for r in ids.read().collect()}
    assert {k: v[0] for k, v in now.items() if k != "c"} == first and now["c"][1] == "two" and len({v[0] for v in now.values()}) == 4
    assert len([p for p in (tmp_path / "ids" / "data").rglob("*.parquet") if p not in files]) <= 1
    got = with_ids(names(spark, "a", "zz", None), ids, "author", "author_id").collect()
    assert sorted(r.author_id or "" for r in got) == ["", "", first["a"]] and got[0].asDict().keys() == {"author_id"}


def test_codes_are_not_renumbered(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "parent long, name string")
    none = spark.createDataFrame([], "parent long, name string, code long")
    one = extended_codes(none, rows((1, "b"), (1, "d"), (2, "x"), (None, "q"), (2, None), (1, "b")))
    two = extended_codes(one, rows((1, "a"), (1, "c"), (1, "d"), (3, "z")))
    assert {(r.parent, r.name): r.code for r in two.collect()} == {(1, "b"): 100, (1, "d"): 101, (1, "a"): 102, (1, "c"): 103, (2, "x"): 200, (3, "z"): 300}
    assert extended_codes(two, rows((1, "a"))).count() == 6
    with pytest.raises(Exception, match="no code left"):
        extended_codes(none, rows(*[(1, f"n{i}") for i in range(11)]), step=10).collect()
    said = spellings(spark.createDataFrame([("臺中市", "臺西", 5), ("雲林縣", "臺西", 6)], "region string, part string, code int"), {"臺": "台"}, "region", "part")
    assert sorted(map(tuple, said.collect())) == sorted([("臺中市", "臺西", 5), ("台中市", "臺西", 5), ("臺中市", "台西", 5), ("台中市", "台西", 5), ("雲林縣", "臺西", 6), ("雲林縣", "台西", 6)])


def test_raw_texts(spark, tmp_path):
    table = raw_table(spark, str(tmp_path / "raw"), buckets=4)
    items = lambda *r: spark.createDataFrame(list(r), "house_id string, is_list boolean, raw string, dict string, seq long")
    upsert_raw(table, items(("1", True, "card", "list dict", 1), ("1", False, "page", "d1", 2), ("1", False, None, "d2", 3), ("2", False, "p", None, 4), ("3", None, "n", "x", 5)), "a")
    held = lambda: {r.house_id: (r.list_raw, r.detail_raw, r.detail_dict) for r in table.read().collect()}
    assert held() == {"1": ("card", "page", "d2"), "2": (None, "p", None), "3": (None, "n", "x")}
    files = {p for p in tmp_path.rglob("*.parquet")}
    upsert_raw(table, items(("1", True, "card", "other", 6), ("2", False, "p", None, 7)), "b")
    assert {p for p in tmp_path.rglob("*.parquet")} == files and table.newest() == 1
    upsert_raw(table, items(("1", True, "card 2", None, 8), ("2", False, "p", None, 9), ("4", True, "new", "no", 10)), "c")
    assert held() == {"1": ("card 2", "page", "d2"), "2": (None, "p", None), "3": (None, "n", "x"), "4": ("new", None, None)}
    assert {r.house_id: r.seq for r in table.read().collect()}["2"] == 4


KIND = "id long, ts timestamp_ntz"


def hot_rows(spark, *rows):
    return spark.createDataFrame([(i, datetime.datetime(2024, 1, d, h)) if d else (i, None) for i, d, h in rows], KIND)


def archived(spark, path):
    return sorted((r.id, r.m, r.d, r.run) for r in spark.read.schema("id long, y int, m int, d int, run string").json(path).collect())


def test_archive(spark, tmp_path, monkeypatch):
    from tenement.sources import archive

    hot, cold = str(tmp_path / "hot"), str(tmp_path / "cold")
    add_hot(hot_rows(spark, (1, 1, 5), (2, 2, 0), (3, 2, 23), (4, 3, 1), (5, None, 0)), "ts", hot)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "hot" / "day=2024-01-03").rglob("*.parquet")}
    real, calls = archive.moved, [0]

    def dies(*a):
        calls[0] += 1
        if calls[0] == 2:
            raise OSError("stopped")
        real(*a)

    monkeypatch.setattr(archive, "moved", dies)
    cutoff = datetime.date(2024, 1, 2)
    with pytest.raises(OSError, match="stopped"):
        archive_days(spark, hot, KIND, cutoff, cold, "r1")
    assert hot_days(spark, hot) == [datetime.date(2024, 1, 2), datetime.date(2024, 1, 3)]
    assert archive_days(spark, hot, KIND, cutoff, cold, "r1") == [cutoff] and archive_days(spark, hot, KIND, cutoff, cold, "r1") == []
    assert archived(spark, cold) == [(1, 1, 1, "r1"), (2, 1, 2, "r1"), (3, 1, 2, "r1")]
    add_hot(hot_rows(spark, (6, 2, 9)), "ts", hot)
    assert archive_days(spark, hot, KIND, cutoff, cold, "r2") == [cutoff]
    assert archived(spark, cold) == [(1, 1, 1, "r1"), (2, 1, 2, "r1"), (3, 1, 2, "r1"), (6, 1, 2, "r2")]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "hot" / "day=2024-01-03").rglob("*.parquet")} == untouched
    assert sorted(r.id for r in read_hot(spark, hot, KIND).collect()) == [4, 5]


def test_large_days_are_several_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' as ts")
    add_hot(rows, "ts", str(tmp_path / "hot"), rows=300)
    archive_days(spark, str(tmp_path / "hot"), KIND, datetime.date(2024, 1, 1), str(tmp_path / "cold"), "r", rows=300)
    assert len(list(tmp_path.glob("cold/y=2024/m=01/d=01/run=r/*.json"))) >= 4 and len(archived(spark, str(tmp_path / "cold"))) == 1000


LITERALS = ["{'a': None, 'b': True, 'c': [False, (1, 2)], 'd': 'None and True'}", "{'q': 'it\\'s \"x\"', \"r\": \"d's None\", 's': '\\xa0é', 't': u'u'}", "[]", "{'n': -1.5e3, 'e': '', 'l': [{'x': ()}]}", "('a', 'b',)"]


def test_literals(spark):
    got = [r.j for r in spark.createDataFrame([(t,) for t in LITERALS], "t string").select(literal_json(F.col("t")).alias("j")).collect()]
    plain = lambda x: [plain(v) for v in x] if isinstance(x, (list, tuple)) else {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else x
    assert [json.loads(j) for j in got] == [plain(ast.literal_eval(t)) for t in LITERALS]
    rows = [('{"top_region": "A", "sub_region": "b"}', "{'region_name': 'X'}"), (None, '{"region_name": "C", "section_name": null}'), ("{bad", "{'region_name': 'D', 'section_name': 'd', 'z': None}"), ("", "{'region_name': "), (None, None), ('{"top_region": null}', "")]
    got = [r.r and tuple(r.r) for r in spark.createDataFrame(rows, "a string, b string").select(region_names(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [("A", "b", "detail"), ("C", None, "card"), ("D", "d", "literal"), None, None, None]


def test_renderings(spark):
    rows = spark.sql("select 1 as id, true as ok, '' as note, named_struct('x', 1.5, 'y', cast(null as double)) as at, 1 as code, map('k', 'v') as m union all select 2, null, 'n', null, 7, null")
    spec = [Field("id", "編號", kind="number"), Field("ok", "好？", kind="boolean", name="is_ok"), Field("note", "註", kind="text"), Field("at", "點", children=("x", "y"), kind="number"), Field("code", "碼", kind="number", enum=("zero", "one")), Field("m", "鍵", key="k", kind="text")]
    people = project(rows, spec, Rendering(letters=False))
    assert people.columns == ["編號", "好？", "註", "點_x", "點_y", "碼", "碼_coding", "鍵"]
    assert sorted(map(tuple, people.collect())) == [("1", "1", "-", "1.5", "-", "1", "one", "v"), ("2", "-", "n", "-", "-", "7", "-", "-")]
    machine = project(rows, spec, Rendering(machine=True))
    assert machine.columns == ["id", "is_ok", "note", "at_x", "at_y", "code", "m"]
    assert [tuple(r) for r in machine.orderBy("id").collect()] == [(1, True, None, 1.5, None, "one", "v"), (2, None, "n", None, None, "7", None)]
    assert project(rows, spec, Rendering(enum=False)).columns == ["編號", "好？", "註", "點_x", "點_y", "碼", "鍵"]
    one = grouped(rows, [Field("ok", "好？", kind="boolean"), Field("id", "數", F.count, kind="number", name="n")], Rendering(machine=True))
    assert one.columns == ["ok", "n"] and {(r.ok, r.n) for r in one.collect()} == {(True, 1), (None, 1)}


def test_modes_by_count(spark):
    from tenement.operators.aggregate import merge_mode, mode_by_count, top_values

    rows = spark.createDataFrame([(k, v, w) for k in (None, "a", "b") for v, w in ((1, None), (1, "y"), (2, "y"), (2, "x"), (2, "x"), (None, None))] + [("c", None, None)] + [("hot", i % 997, "z") for i in range(3000)], "k string, v int, w string")
    assert sorted(map(str, mode_by_count(rows, ["k"], ["v", "w"]).collect())) == sorted(map(str, merge_mode(rows, ["k"], ["v", "w"]).collect()))
    assert [tuple(r) for r in top_values(rows.where("k = 'a' or k = 'c'"), ["k"], "w", 5).orderBy("place").collect()] == [("a", 1, "x", 2), ("a", 2, "y", 2)]
