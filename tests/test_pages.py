"""Trees and fields of pages, cards, and reparsing in ranges that stops and goes on."""

import json

import pytest

from tenement.extract.listing_page import LISTING, coordinate, listing_details, parse_listing, pattern
from tenement.extract.tree import clean, find, has, inside, shown, texts, tree
from tenement.operators.backfill import listing_table, reparse_ranges
from tenement.plans import scrape

SF = "/root/testdata/sf0.001"
NAMES = [c.split()[0] for c in LISTING.split(", ")]


def told(html):
    return dict(zip(NAMES, parse_listing(html), strict=True))


def test_tree():
    root = tree('<div class="a b"><p>one<br>two<p class=b>x</div><span>out</i></span><img class="a" src=q/>&amp;')
    assert [e.tag for e in root.walk()] == ["div", "p", "br", "p", "span", "img"] and root.text() == "onetwoxout&"
    assert [e.text() for e in find(root, has("a"), has("b"))] == ["x"] and find(root, has("b", tag="div"))[0].classes == {"a", "b"}
    assert [e.tag for e in inside([root], has(without="a"))] == ["span"] and find(root, has("zz")) == [] and tree("").text() == ""
    deep = tree("<div>" * 20_000 + "x")
    assert deep.text() == "x" and len(find(deep, has(tag="div"))) == 20_000
    assert clean([" \xa0a ", None, "", "\xa0"]) == ["a"]


def test_plain_markup_reads_like_any():
    import random

    from tenement.extract import tree as M

    def told_of(root):
        return [(e.tag, e.attrs, e.classes, e.parts and [p if isinstance(p, str) else p.number for p in e.parts], [x.number for x in e.walk()]) for e in [root, *root.walk()]]

    def general(html):
        b = M._Builder()
        b.feed(M.whole_references(html))
        b.close()
        return b.page.root

    pieces = ["<p>", "</p>", "<div class='a b'>", "</div>", "<br/>", "<img src=q/>", '<a href="x" class=c class=d>', "</a>", "text", "&amp;", "&lt", "<!-- c -->", "<!-->", "<!doctype html>", "<script>", "</script>", "<script>if(a<b)&amp;</script>", "<title>t&amp;</title>",
              "<title>", "<B>", "<x-y z>", "<input disabled/>", "<p a=1 b='2'c=3>", "< p>", "<", ">", "<li", "<?php ?>", "\r\n", "<style>p{}</style>", "<a\tb\n=c>", "<plaintext>", "</>", '<p a="&amp;<">', "--", "-->"]
    draw, plain = random.Random(3), 0
    for _ in range(4000):
        html = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 8)))
        page = M.plain_tree(M.whole_references(html))
        plain += page is not None
        assert page is None or told_of(page.root) == told_of(general(html)), html
    assert plain > 400


@pytest.mark.parametrize("name", ["h1_listing_detail", "n0_normalize_listings", "h2_listing_cards", "h2_card_items"])
def test_rows_are_dealt_before_they_grow_to_pages(spark, name):
    plan = getattr(scrape, name)(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "class=" in plan and "Exchange hashpartitioning" in plan and "class=" not in plan.rsplit("Exchange hashpartitioning", 1)[1]


def test_stored_pages_are_written_by_many_tasks(spark, monkeypatch):
    from tenement.plans import scrape as S

    seen = []
    monkeypatch.setattr(S, "listing_table", lambda stored, *a, **b: seen.append(len(stored.inputFiles())) or (_ for _ in ()).throw(Stopped))
    with pytest.raises(Stopped):
        S.h4_reparse_ranges(spark, SF)
    assert seen == [spark.sparkContext.defaultParallelism]


def test_reordered_rows_are_dealt(spark):
    from tenement.plans import releases

    assert releases.h3_reordered_text(spark, SF).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_references_end_with_a_semicolon():
    from tenement.extract.html import parse_cards, parse_detail

    page = '<html lang="en"><title>a &amp;&amp</title><script>x&lt</script><!-- &lt --><h1>&ltb &#39 &#x27; &notit; &copy;</h1><a href="/?a=1&copy=2&amp;b">&middot; c&gt</a>'
    assert parse_detail(page)[:4] == ("a &&amp", "en", "&ltb &#39 ' &notit; ©", ["· c&gt"]) and parse_cards(page) == [(1, "/?a=1&copy=2&b", "· c&gt")]
    root = tree(page)
    assert [e.text() for e in root.walk()] == [root.text(), "a &&amp", "x&lt", "&ltb &#39 ' &notit; ©", "· c&gt"]


def test_reparse_keeps_cut_references(spark):
    from tenement.extract.html import reparse

    base = spark.createDataFrame([(1, 0, "old", None, None, 0)], "page_id long, status int, title string, lang string, heading string, seq long")
    pages = spark.createDataFrame([(1, "<html lang=en><title>a &amp;&amp</title><h1>b&lt</h1>"), (2, "<title>&gt;</title>")], "page_id long, html string")
    assert sorted((r.page_id, r.title, r.heading) for r in reparse(base, pages).collect()) == [(1, "a &&amp", "b&lt"), (2, ">", None)]


def test_reparse_gives_every_page_its_row(spark, tmp_path):
    import duckdb

    from tenement.plans import catalog

    whole = '<html lang="en"><title>%s</title><h1>h</h1>'
    data = [(2, None), (3, None), (4, whole % "a"), (4, whole % "b"), (5, whole % "a"), (5, whole % "b"), (None, whole % "c"), (None, whole % "d"), (6, ""), (7, ""), (8, whole % "e")]
    spark.createDataFrame(data, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES["h4_reparse_raw"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(con.execute(catalog.ORACLE["h4_reparse_raw"]).fetchall(), key=str)


def test_shown_texts():
    row = '<b><span style="display:inline-flex;flex-direction: row; %s"><i style="order:2">b</i><i style="order:10">c</i><i style="order:1">a</i></span></b>'
    assert [shown(find(tree(row % x), has(tag="b"))[0]) for x in ("", "flex-direction: row-reverse")] == ["abc", "cba"]
    assert texts(find(tree("<b>own<i>x</i></b><b><i>y</i></b><b> </b>"), has(tag="b"))) == ["own"]


def test_listing_parts():
    assert pattern(["a", "b", "車位"], ["x", "y"]) == {"property_type": "車位"} and pattern([], []) == {"property_type": None, "building_type": None}
    assert pattern(["a"], ["t", "9坪", "1F", "公寓", "more"])["building_type"] == "公寓" and pattern([], ["t", "公寓", "z"]) == {"property_type": "t", "building_type": "公寓"}
    assert coordinate("https://m/?hl=x&q=23.04,120.24&z=1") == "23.04,120.24" and coordinate("https://m/?q=51.5,0.1") is None and coordinate(None) is None
    bare = told("<p>nothing</p>")
    assert bare["parse_errors"] == ["title", "breadcrumb", "price", "author_name"] and bare["misc"] == {} and not bare["error"]
    assert told("<p class=error-info>gone")["parse_errors"] == [] and told("<p class=error-info>gone")["error"]


def test_bad_pages_stay_alone(spark, monkeypatch):
    from tenement.extract import listing_page

    def picky(html):
        if "bad" in html:
            raise KeyError(html)
        return parse_listing(html)

    monkeypatch.setattr(listing_page, "parse_listing", picky)
    pages = spark.createDataFrame([(1, "<h1>x"), (2, "bad"), (3, None), (4, ""), (5, "<div class=title><h1>t</h1></div>")], "house_id long, raw string")
    got = {r.house_id: r for r in listing_details(pages).collect()}
    assert set(got) == {1, 2, 4, 5} and got[2].parse_errors == ["KeyError"] and got[2].error is None and got[5].title == "t"
    assert {r.house_id for r in listing_page.raw_listings(pages).collect()} == {"1", "4", "5"}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("where", ["merge", "note"])
def test_reparse_killed_between_ranges(spark, tmp_path, monkeypatch, where):
    from tenement.operators import backfill

    stored, names = scrape.pages(spark, SF).cache(), scrape.regions(spark)
    whole = listing_table(stored, names, str(tmp_path / "whole"), buckets=4)
    assert reparse_ranges(stored, names, whole, str(tmp_path / "w"), size=1000) == [0]
    want = sorted(map(str, whole.read().collect()))
    target, count = listing_table(stored, names, str(tmp_path / "parts"), buckets=4), [0]
    real = {"merge": type(target).merge, "note": backfill.write_small}[where]

    def dies(*a, **b):
        count[0] += 1
        if count[0] == 2:
            raise Stopped
        return real(*a, **b)

    monkeypatch.setattr(*((type(target), "merge") if where == "merge" else (backfill, "write_small")), dies)
    ledger = str(tmp_path / "ledger")
    with pytest.raises(Stopped):
        reparse_ranges(stored, names, target, ledger, size=110)
    assert reparse_ranges(stored, names, target, ledger, size=110) == [1] and reparse_ranges(stored, names, target, ledger, size=110) == []
    assert sorted(map(str, target.read().collect())) == want and target.newest() == 1
    notes = [json.loads((tmp_path / "ledger" / str(k)).read_text()) for k in range(2)]
    assert sum(n["items"] for n in notes) == len(want) == sum(n["pages"] for n in notes)


def test_reparse_keeps_what_pages_do_not_tell(spark, tmp_path):
    names = scrape.regions(spark)
    page = '<div class="title"><h1>t</h1></div><div class="crumbs"><a class="t5-link">A市</a><a class="t5-link">甲區</a><a class="t5-link">雅房</a></div><div class="house-price"><p class="c-price"><b class="inline-flex-row">9,000</b></p></div><div class="contact-card"><b class="name">屋主: X</b>%s</div>'
    phone = '<div class="phone"><div class="contact-action-lg"><button><span><span>09-1</span></span></button></div></div>'
    rows = lambda *r: spark.createDataFrame(list(r), "house_id long, raw string")
    first = rows((7, page % phone), (None, page), (8, None), (-1, page % ""))
    target = listing_table(first, names, str(tmp_path / "t"), buckets=2)
    assert reparse_ranges(first, names, target, str(tmp_path / "a"), size=10) == [-1, 0]
    assert reparse_ranges(rows((7, page % "")), names, target, str(tmp_path / "b"), size=10, seq=2) == [0]
    assert reparse_ranges(rows((-1, "<p class=error-info>")), names, target, str(tmp_path / "c"), size=10, seq=3) == [-1]
    got = {r.vendor_house_id: r for r in target.read().collect()}
    assert (got["7"].author, got["7"].contact, got["7"].monthly_price, got["7"].seq) == ("091", 0, 9000.0, 2)
    assert (got["-1"].deal_status, got["-1"].monthly_price, got["-1"].author) == (1, 9000.0, None) and len(got) == 2


CARD = '<div class="%s"><div class="item-info-title"><a href="%s">t</a></div><div class="item-info-txt"><span>%s</span></div></div>'


def test_cards_stay_apart(spark, monkeypatch):
    from tenement.extract import list_page as LP

    plain = LP.regular

    def picky(card):
        if "bad" in card.text():
            raise ValueError
        return plain(card)

    monkeypatch.setitem(LP.KINDS, "regular", (*LP.KINDS["regular"][:2], picky))
    page = CARD % ("item", "https://x/1?a=b", "雅房") + CARD % ("item", "https://x/2", "bad") + '<div class="item"><a>no link</a></div>' + CARD % ("item", "https://x/3", "車位")
    cards = list(LP.parse_list(page))
    assert [(c[0], c[2], c[6], c[-1]) for c in cards] == [(1, "1", "雅房", []), (2, "2", None, ["ValueError"]), (3, "3", "車位", [])]
    monkeypatch.undo()
    pages = spark.createDataFrame([(1, page, "A市"), (2, None, "A市"), (3, "", None), (4, "<div class=item>" * 3000, "B縣"), (None, page, None)], "page_id long, raw string, city string")
    got = LP.list_cards(pages, "page_id", "raw", "city", parts=3)
    assert sorted((r.page_id or 0, r.pos) for r in got.collect()) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3)]
    items = {(r.vendor_house_id, r.top_region): r for r in LP.card_items(got, scrape.regions(spark)).collect()}
    assert items["1", 1].present == ["top_region", "property_type"] and items["3", None].present == ["property_type"] and items["3", None].property_type == 4


def test_a_page_that_breaks_gives_its_error(monkeypatch):
    from tenement.extract import list_page as LP

    monkeypatch.setattr(LP, "parse_list", lambda html: (_ for _ in ()).throw(RuntimeError("x")))
    rows = list(LP.ListCards().eval("<p>"))
    assert [r[-1] for r in rows] == [["RuntimeError"]] and len(rows[0]) == len(LP.NAMES) and list(LP.ListCards().eval(None)) == []


def test_card_lines():
    from tenement.extract.list_page import NAMES, regular

    def card(*lines):
        return regular(tree("".join(f'<div class="item-info-txt">{x}</div>' for x in lines)))

    seen = "<span>屋主 X</span><span>今天</span><span>9人</span>"
    with_mark = card("<span>雅房</span>", "", "<span>距車站</span><strong>5公尺</strong>", seen)
    assert (with_mark["nearby_landmark"], with_mark["contact_info"], with_mark["view_count"]) == ("距車站", "屋主 X", "9人")
    without = card("<span>雅房</span>", "", seen)
    assert "nearby_landmark" not in without and without["update_time"] == "今天" and set(without) <= set(NAMES)
    assert card("<span>雅房</span>", "", "<span></span>", seen)["contact_info"] == "屋主 X" and "contact_info" not in card("<span>雅房</span>")


def test_cards_are_found_by_number(monkeypatch):
    from tenement.extract import list_page as LP
    from tenement.extract import tree as M

    page = '<div class="item x"><div class="item-info-title"><a href="/9?a">t</a></div><div class="item-info-txt"><span>雅房</span></div></div><p class="recommend-ware item"><a class="title" href="7">u</a></p>'
    want = [("regular", "9", "t", "雅房"), ("promoted", "7", "u", None)]
    pick = [LP.NAMES.index(n) for n in ("kind", "house_id", "title", "property_type")]
    assert M.has("a", tag="b") is M.has("a", tag="b") and [tuple(r[i] for i in pick) for r in LP.parse_list(page)] == want
    monkeypatch.setattr(M.Element, "walk", lambda e: (_ for _ in ()).throw(AssertionError("every element is looked at")))
    assert [tuple(r[i] for i in pick) for r in LP.parse_list(page)] == want
