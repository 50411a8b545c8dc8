"""Operators against brute force on small fixtures, with nulls, empty and repeated texts, ties and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenement.llm import chat, decontaminate, kneser_ney, licenses, mixing, pii, quality, simhash, syncmers, toxicity

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "one two three four", "one two three four", "mail a.b@c.de_x@y.zz now +1 (743) 555-3824 ok", "ip 1.2.3.4 bad 1.2.3.400 card 4111 1111 1111 1111 end", "All rights reserved. CC BY 4.0",
         "released under the MIT license", "käse " * 300, "token = \"" + "ab12" * 10 + "\" x", "a.b@c.de.f 00.0.00255.9 12 34"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i else None, None if i == 3 else f"s{i % 3}", len(t or ""), 7) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "en", "s2", 18, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    luhn = lambda d: sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))), "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)}
    return {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(rx, t or "") if ok(m.group())] for k, (rx, ok) in rules.items()}


@pytest.mark.parametrize("source", ["fixture", "table"])
def test_pii_base(spark, docs, source, tmp_path):
    if source == "fixture":
        docs.write.parquet(str(tmp_path / "documents.parquet"))
    sf = SF if source == "table" else str(tmp_path)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.op9_pii(spark, sf).collect():
        want = base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in want.values()]
        assert r.base_sha256 == hashlib.sha256(",".join(itertools.chain(*want.values())).encode()).hexdigest()


def test_pii_bootstrap(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(12)]
    rows = [f'so token = "{h}" then' for h in hexes] + [f'so token = "ZX-8{i}-QQPL" then' for i in range(3)]  # these words are known by the token pattern only
    rows += [f"with badge number ZX-8{i}-QQPL today" for i in range(3)] + ["with badge number QK-77-AAXZ today", 'my token = "lettersonly" x', "in chapter number 123456 of it", "plain words only", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [(e.kind, rows[r.doc_id][e.start:e.end]) for e in r.extra] for r in pii.find_pii(docs).collect()}
    assert [got[i] for i in range(12)] == [[("secret", h)] for h in hexes]
    assert got[12] == [("id", "ZX-80-QQPL")] and got[18] == [("id", "QK-77-AAXZ")] and got[19] == [("id", "lettersonly")]
    assert got[20] == got[21] == got[22] == []
    clean = {r.doc_id: r.text for r in pii.redact(docs, pii.find_pii(docs)).collect()}
    assert clean[18] == "with badge number [ID] today" and clean[21] == rows[21] and clean[22] is None


def test_pii_overlap_and_many(spark):
    import time

    from pyspark.sql import functions as F

    many = " ".join(f"a{i}@b.cd 10.0.{i % 200}.1" for i in range(8000))
    docs = spark.createDataFrame([(1, "x 10.0.0.1@host.org y"), (2, many), (3, "")], "doc_id long, text string").withColumn("_k", F.lit(1)).withColumn("spans", F.lit(2))
    found = pii.find_pii(docs)
    began = time.time()
    out = {r.doc_id: r.text for r in pii.redact(docs, found).collect()}
    assert out[1] == "x [EMAIL] y" or out[1] == "x [IP] y"
    assert out[2] == " ".join("[EMAIL] [IP]" for _ in range(8000)) and time.time() - began < 60


def test_running(spark):
    for n in (0, 1, 2, 7, 100, 101):
        rows = spark.createDataFrame([(list(range(n)),)], "a array<bigint>").select(pii.running(pii.F.col("a"), lambda a, x: a + x).alias("s")).first()
        assert rows.s == list(itertools.accumulate(range(n)))


def test_simhash_components(spark, docs):
    both = docs.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 1000", "text"))
    got = simhash.near_duplicates(both).collect()
    fp = {r.doc_id: r.fp & (2**64 - 1) for r in got}
    root = {i: i for i in fp}
    for _ in range(len(fp)):
        new = {i: min(root[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 2) for i in fp}
        if new == root:
            break
        root = new
    assert len(got) == both.count() and all(r.component_id == root[r.doc_id] for r in got)
    assert fp[0] == fp[1] == 0


def test_anchor_chain(spark):
    points = spark.createDataFrame([(0,), (3,), (15,), (-1,), (-4,), (1 << 40,)], "fp long")
    found = {r.u: r.root for r in simhash.components(simhash.anchor_links(points)).collect()}
    got = {i: found.get(i, i) for i in (0, 3, 15, -1, -4, 1 << 40)}
    assert got[15] == got[3] == got[0] == got[1 << 40] != got[-1] == got[-4]


def test_anchors_link_every_pair(spark):
    import random

    from pyspark.sql import functions as F

    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    points = {b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 3))) for b in base for _ in range(40)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(signed(x),) for x in points], "fp long")
    got = {(r.u, r.v) for r in simhash.anchor_links(rows).collect()}
    want = {(max(a, b), min(a, b)) for a, b in itertools.combinations(map(signed, points), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want and len(want) > 100
    assert set(rows.select(F.size(simhash.anchors(F.col("fp"))).alias("n")).distinct().toPandas().n) <= {2, 33}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0


def test_components_few_tasks(spark):
    sc, chain = spark.sparkContext, spark.range(8, numPartitions=64).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    repeated = chain.union(spark.createDataFrame([(30, 20), (30, 20), (31, 20), (31, 30), (50, 41), (50, 42), (50, 43)], "u long, v long"))
    sc.setJobGroup(group := "components-few-tasks", "")
    try:
        found = simhash.components(repeated)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    told = sc.statusTracker()
    stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
    done = sum(i.numCompletedTasks for i in map(told.getStageInfo, stages) if i)
    assert 64 < done < 4 * 64  # the links are written and counted once in as many parts as they come, and then read by few tasks
    rows = sorted(map(tuple, found.collect()))
    assert rows == [*((i, 0) for i in range(1, 9)), (30, 20), (31, 20), (42, 41), (43, 41), (50, 41)]


def test_pipeline_near_dedup(spark):
    import corpus_pipeline

    long = [f"w{i * i % 997}x{i}" for i in range(120)]
    edit = lambda *at: " ".join("changed" if i in at else w for i, w in enumerate(long))
    rows = [(5, " ".join(long)), (4, edit(60)), (9, edit(20, 90)), (7, edit(*range(0, 120, 4))), (1, "short one"), (2, "Short  ONE"), (None, "gone astray"), (None, "gone astray"), (None, edit(119)), (8, None), (3, "")]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 3, 4, 7]


def test_near_links_complete(spark):
    import random

    from tenement.llm import neardup

    draw = random.Random(1)
    base = [f"v{i}" for i in range(200)]
    texts = {k: " ".join("z" if draw.random() < 0.012 else w for w in base) for k in range(60)}
    sets = {k: set(neardup.shingles(t).tolist()) for k, t in texts.items()}
    root = {k: k for k in texts}
    for _ in texts:
        root = {i: min(root[j] for j in texts if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in texts}
    found = {r.u: r.root for r in simhash.components(neardup.similar_links(spark.createDataFrame(list(texts.items()), "key long, text string"))).collect()}
    assert {k: found.get(k, k) for k in texts} == root and len(set(root.values())) > 1


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r.taken <= 3 * r.size for r in got)
    for s in {r.source for r in got}:
        part = [r for r in got if r.source == s]
        assert part[0].source_size == sum(r.size for r in part) and part[0].target <= 3 * part[0].source_size + 1e-6
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(3, 0.05 * part[0].target)
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(r.size for r in got)) < 1e-6
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)


def test_mixed_blocks(spark, docs):
    sources = spark.createDataFrame([(1, 120_000), (2, 279_999), (3, 1), (4, 0)], "sid int, slots long")
    counts = {(r.shard, r.sid): r["count"] for r in mixing.shard_counts(sources).collect()}
    shards = {k: sum(c for (j, _), c in counts.items() if j == k) for k, _ in counts}
    assert sorted(shards) == list(range(98)) and [shards[k] for k in range(98)] == [4096] * 97 + [400_000 - 97 * 4096]
    spread = [(counts[k, 1] - 0.3 * 4096) ** 2 / (0.3 * 0.7 * 4096) for k in range(97)]  # a binomial count's squared deviation over its variance
    assert 0.6 < sum(spread) / 97 < 1.5 and all(sid < 4 for _, sid in counts)
    got = mixing.mixed_blocks(docs, block=2).collect()
    assert len({(r.shard, r.position) for r in got}) == len(got) and max(Counter((r.source, r.block) for r in got).values()) <= 3
    assert {len(r.tokens) for r in got} <= {1, 2}
    for s in {r.source for r in got}:
        mixed = Counter(w for r in got if r.source == s for w in r.tokens)
        own = Counter(w for r in docs.collect() if r.source == s for w in words(r.text))
        assert set(mixed) <= set(own) and all(mixed[w] <= 3 * own[w] for w in mixed)
    digest = mixing.mix(docs, block=2).groupBy("source").agg(F.sum("taken").alias("taken")).collect()
    assert {r.source: r.taken for r in digest if r.taken} == dict(Counter(r.source for r in got for _ in r.tokens))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs.where("text is null")).collect()[0].taken == 0


def spark_hash(*values):
    """Spark's xxhash64 of these columns: each hashed with the hash so far as its seed, nulls passed over."""
    seed = 42
    for v, kind in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if kind == "text" else v.to_bytes(8 if kind == "long" else 4, "little", signed=True), seed % 2**64)
    return (seed + 2**63) % 2**64 - 2**63


def plain_mix(rows, block):
    """(doc_id, size, target, taken) of every row by loops over words and slots."""
    size = [len(words(t)) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for z, r in zip(size, rows) if r[2] == n) for n in names}
    weight = {n: (5.0, 2.0, 1.0)[i % 3] for i, n in enumerate(names)}
    target, free, left = {}, list(names), float(sum(size))
    while free:
        level = left / sum(weight[n] for n in free)
        held = [n for n in free if weight[n] * level > 3 * total[n]]
        target.update({n: 3.0 * total[n] if held else weight[n] * level for n in held or free})
        left, free = left - sum(target[n] for n in held), [n for n in free if n not in held] if held else []
    streams, slots = {n: [] for n in names}, {}
    keyed = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, spark_hash((rows[i][1] or "", "text"), (rows[i][2], "text"))))
    for i in keyed:
        streams[rows[i][2]] += [i] * size[i]
    for n in names:
        goal, blocks = math.floor(target[n] + 0.5), -(-total[n] // block)
        slots[n] = goal // total[n] * blocks + -(-(goal % total[n]) // block) if total[n] else 0
    taken = Counter()
    for n in names:
        full, blocks, goal = total[n] // block, -(-total[n] // block), math.floor(target[n] + 0.5)
        for j in range(slots[n]):
            step, i = divmod(j, blocks)
            x, salt = i, spark_hash((17, "int"), (names.index(n) + 1, "int"), (step, "long"))
            for r in range(8 if i < full else 0):
                other = (spark_hash((salt, "long"), (r, "int")) % full - x) % full
                x = other if spark_hash((salt, "long"), (r + 1000, "int"), (max(x, other), "long")) % 2 else x
            taken.update(streams[n][x * block:min(x * block + block, x * block + goal - step * total[n] - i * block)])
    return sorted(((rows[i][0], size[i], round(target[rows[i][2]], 6), taken[i]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_mix_brute_force(spark, docs, block):
    rows = [(r.doc_id, r.text, r.source) for r in docs.distinct().collect()] + [(r.doc_id + 100, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40").collect()] + [(None, "no id here", "s0")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=block).collect()
    assert sorted(((r.doc_id, r["size"], round(r.target, 6), r.taken) for r in got), key=str) == plain_mix(rows, block)


def test_mix_repeated_rows(spark):
    from pyspark.sql import functions as F

    copies = spark.range(9000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("four words of text").alias("text"), F.lit("a").alias("source"))
    got = mixing.mix(copies.union(spark.createDataFrame([(6, "b b", "b"), (7, None, None)], "doc_id long, text string, source string"))).collect()
    assert len(got) == 9002 and sum(r.taken for r in got) == 36002 and max(r.taken / max(r["size"], 1) for r in got) <= 3
    assert [r.taken for r in got if r.doc_id == 6] == [6] and [r.taken for r in got if r.doc_id == 7] == [0]


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_edited_texts(docs):
    text = dict(sorted({i: t or "" for i, t in enumerate(TEXTS)}.items()))
    ids = list(text)
    got = {r.doc_id: r.edited for r in syncmers.edited_texts(docs).collect()}
    for at, i in enumerate(ids):
        k = len(text[i]) // 4
        assert got[i] == text[i][:len(text[i]) - k] + text[ids[(at + 1) % len(ids)]][:k]


def test_syncmer_query(spark):
    got = syncmers.op10_syncmers(spark, SF).collect()
    assert sum(r.near_edited > r.near_next for r in got) >= 0.9 * len(got)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = {}
    assert all(seen.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint for r in got)


def test_syncmers_any_length(spark, tmp_path):
    long = " ".join(f"w{i * i % 7919}" for i in range(4000))
    texts = [" ".join(f"a{i:04d}" for i in range(183)), "tiny!", long[:1020], long[:1020] + " more text", long, " ".join(f"x{i}" for i in range(4000)) + " " + long[-900:], "日本語の文" * 3, "q"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in syncmers.op10_syncmers(spark, str(tmp_path)).collect()}
    assert got[0].n_chars > 1024 and got[0].near_edited > 0.7
    assert got[2].near_next > 0.95 and 0 < got[4].near_next < 0.1
    assert len(got[4].fingerprint) > 8 * 2000
    assert got[6].near_edited > 0.3 and len(got[7].fingerprint) > 0


def test_syncmers_every_row(spark, tmp_path):
    rows = [(1, "one two three four"), (2, "zz yy xx ww vv"), (2, "aa bb cc dd ee"), (2, "aa bb cc dd ee"), (None, "no id at all"), (None, "none here either"), (None, None), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    nexts = {1: "aa bb cc dd ee", 2: "", 3: "one two three four", None: ""}
    edits = [(i, t[:len(t) - len(t) // 4] + nexts[i][:len(t) // 4]) for i, t in ((i, t or "") for i, t in rows)]
    got = syncmers.op10_syncmers(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=str) == sorted(((i, hashlib.sha256(e.encode()).hexdigest()) for i, e in edits), key=str)
    assert sorted(len(r.fingerprint) > 0 for r in got) == [False] * 2 + [True] * 6


def test_licenses(docs):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[6].n_base, got[6].first_word, got[6].last_word, got[6].base_labels) == (2, 0, 3, "cc-by,reserved")
    assert got[7].labels == "mit" and got[7].n_base == 0 and got[1].n_words == 0 and got[8].score == 0


def test_chat_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(f"select conv_id, n_turns, n_copies, rendered from ({chat.OP1_SQL})").fetchall()
    assert sorted(map(tuple, chat.op1_chat(spark, SF).collect())) == sorted(want)


def test_chat_edges(spark):
    """Nulls, ties, equal and empty conversations, names that clash."""
    rows = [("a", 1, "user", "hi"), ("a", 2, "bot", "yo"), ("b", 1, "user", "hi"), ("c", 1, "user", "hi"), ("c", 2, "bot", "yo"), ("d", 1, "user", None), ("e", 1, "user", ""), (None, 1, "user", "hi"),
            ("f", None, "user", "x"), ("f", 1, "user", "y"), ("g", 1, "user", "q"), ("g", 1, "bot", "q")]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id string, turn int, role string, text string, n int, a int")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.render(turns, chat.maximal_conversations(turns)).collect()}
    assert set(got) == {"a", "d", "e", "f", "g"} and got["a"] == (2, 2, "<|user|>\nhi\n<|bot|>\nyo\n")
    assert got["f"][2] == "<|user|>\nx\n<|user|>\ny\n" and got["g"][2] == "<|bot|>\nq\n<|user|>\nq\n"
    assert chat.maximal_conversations(turns.limit(0)).count() == 0


def test_decontaminate(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, f"x y {item} z"), (2, f"q {item.replace('delta', 'other')} w"), (3, "nothing to see in here at all"), (4, None), (4, "")], "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == {(1, 9), (2, 9)}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_decontaminate_templates(spark):
    stem = "what is the capital city of the country called"
    items = spark.createDataFrame([(i, f"{stem} {w}") for i, w in enumerate(("norway", "peru", "ghana", "nepal"))] + [(7, "quid novi"), (8, "xyzzy")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {stem} peru then"), (2, stem.replace("what is the", "name some other") + " peru"), (3, "say quid novi or not"), (4, "novi quid"), (5, "plain text of the day"), (None, f"a {stem} ghana"), (None, "clean of it"), (6, "XYZZY")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, items).collect()}
    assert got[1, 1] == 1 and got[2, 1] >= 0.5 and got[None, 2] == 1 and got[3, 7] == 1 and got[6, 8] == 1
    assert {k[0] for k in got} == {1, 2, 3, 6, None}
    kept = decontaminate.without_contaminated(docs, items).collect()
    assert sorted(r.text for r in kept) == ["clean of it", "novi quid", "plain text of the day"]


def test_decontaminate_shared_stem(spark):
    """A phrase of many items is no seed: texts that hold it alone match none, and only their own item those that hold one."""
    stem = "choose the correct answer from the list below"
    items = spark.createDataFrame([(i, f"{stem} " + " ".join(f"w{i}x{j}" for j in range(4))) for i in range(300)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"page {i} {stem} and go on with part {i}") for i in range(200)] + [(500, f"{stem} w7x0 w7x1 w7x2 w7x3"), (501, f"so {stem} w9x0 w9x1 but w9x3")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == {(500, 7), (501, 9)}
    table = decontaminate.seeds(items.withColumn("n", F.lit(12)))
    assert [size for size, _ in table] == [3] and table[0][1].groupBy("h").count().where("count > 2").count() == 0


def test_decontaminate_no_rare_trigram(spark):
    """Items made of the same phrases in other orders: longer runs are their seeds. Items of equal words are found under each id."""
    parts = [f"p{i}a p{i}b p{i}c p{i}d" for i in range(4)]
    orders = [" ".join(parts[k] for k in o) for o in itertools.permutations(range(4))]
    items = spark.createDataFrame([*enumerate(orders), (90, orders[5].upper())], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {orders[5]} y"), (2, f"{parts[2]} alone"), (3, "word " * 200_000 + orders[9])], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect() if r.score == 1}
    assert got == {(1, 5), (1, 90), (3, 9)}


def test_decontaminate_common_short_items(spark):
    """The operator reports short items wherever they stand; the filter keeps texts that hold common ones."""
    docs = spark.createDataFrame([(i, f"the text number{i} of many") for i in range(20)] + [(30, "holds quid novi here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "quid novi"), (3, "")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 21
    assert sorted(r.doc_id for r in decontaminate.without_contaminated(docs, items).collect()) == list(range(20))


def test_decontaminate_recall(spark):
    """Against Smith-Waterman of every item with every whole text, where texts hold edited copies of real items."""
    rng = random.Random(3)
    items = [(r.item_id, decontaminate_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [decontaminate_words(r.text)[:120] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    docs = []
    for i, w in enumerate(texts):
        copy = list(items[i % len(items)][1])
        for _ in range(rng.randrange(0, max(2, len(copy) // 5))):
            at = rng.randrange(len(copy))
            copy[at:at + 1] = rng.choice([[], [f"new{rng.random()}"], [copy[at], f"put{rng.random()}"]])
        docs.append((i, w + copy + w[:20] if i % 3 else w))
    want = {(d, i) for d, t in docs for i, a in items if decontaminate.align(np.array(a, dtype=object), np.array(t, dtype=object)) >= 0.5}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(
        spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(a)) for i, a in items], "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) > 30


def decontaminate_words(text):
    return re.findall(decontaminate.WORDS, (text or "").encode().lower().decode())


def plain_kneser_ney(training, texts):
    """n_tokens, n_known, train_tokens, base_score, score by dictionaries."""
    import math

    tokens = lambda t: ["<s>", "<s>", *words((t or "").encode().lower().decode()), "</s>"]
    c3, one = Counter(), Counter()
    for t in map(tokens, training):
        one.update(t[2:])
        c3.update(zip(t, t[1:], t[2:]))
    c2 = Counter()
    for (_, v, w), c in c3.items():
        c2[v, w] += c if v == "<s>" else 1
    c1 = Counter(w for _, w in c2)
    c3 = {k: c for k, c in c3.items() if k[1] != "<s>"}
    d3, d2, d1 = (kneser_ney.discounts([sum(c == i for c in x.values()) for i in (1, 2, 3, 4)]) for x in (c3, c2, c1))
    total, spare = Counter(), Counter()
    for c_all, d in ((c3, d3), (c2, d2), (c1, d1)):
        for k, c in c_all.items():
            total[k[:-1] if c_all is not c1 else ()] += c
            spare[k[:-1] if c_all is not c1 else ()] += d[min(c, 3)]
    v_size, n = len(one), sum(one.values())

    def mixed(c, d, context, low):
        return (max(c - d[min(c, 3)], 0) + spare[context] * low) / total[context] if total[context] else low

    def p(u, v, w):
        return mixed(c3.get((u, v, w), 0), d3, (u, v), mixed(c2.get((v, w), 0), d2, (v,), mixed(c1.get(w, 0), d1, (), 1 / (v_size + 1))))

    for t in map(tokens, texts):
        yield len(t) - 2, sum(one[w] > 0 for w in t[2:]), n, sum(math.log10((one[w] + 1) / (n + v_size + 1)) for w in t[2:]), sum(math.log10(p(*x)) for x in zip(t, t[1:], t[2:]))


@pytest.mark.parametrize("training", ["all", "some", "none"])
def test_kneser_ney(spark, docs, training):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    every = spark.createDataFrame(rows, "doc_id long, text string")
    keep = {"all": "true", "some": "doc_id % 3 > 0", "none": "false"}[training]
    used = [t for i, t in rows if training == "all" or training == "some" and i % 3]
    want = {i: x for (i, _), x in zip(rows, plain_kneser_ney(used, [t for _, t in rows]))}
    got = kneser_ney.scored(every, every.where(keep)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:4] == want[r.doc_id][:3] and all(abs(a - b) <= 1e-8 * max(1, abs(b)) for a, b in zip(tuple(r)[4:], want[r.doc_id][3:]))


@pytest.mark.parametrize("bits", [3, 6])
def test_kneser_ney_small_files(spark, bits, tmp_path):
    """Frequent words dealt over several files, many flushes, contexts with stored sums: as the same text in one process."""
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "run.py"
    script.write_text(f"""
import random, sys, json
sys.path.insert(0, {str(Path(__file__).parents[2])!r})
import numpy as np, pyarrow as pa, pandas as pd
from tenement.llm import kneser_ney as K
K.SHARD, K.FLUSH, K.PART, K.MANY, K.BITS = {1 << bits}, 100, 7, 3, 7
from tests.llm.test_operators import plain_kneser_ney
draw = random.Random(3)
texts = [" ".join(draw.choice([f"w{{i}}" for i in range(40)][:draw.choice([2, 5, 40])]) for _ in range(draw.randint(0, 60))) for _ in range(120)]
from pyspark.sql import SparkSession
import pyspark.cloudpickle
pyspark.cloudpickle.register_pickle_by_value(K)
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
got = {{r.doc_id: tuple(r)[1:] for r in K.scored(docs, docs.where("doc_id % 3 > 0")).collect()}}
for i, want in enumerate(plain_kneser_ney([t for i, t in enumerate(texts) if i % 3], texts)):
    assert got[i][:3] == want[:3] and all(abs(a - b) < 1e-8 * max(1, abs(b)) for a, b in zip(got[i][3:], want[3:])), (i, got[i], want)
print("same")
""")
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300, check=False)
    assert "same" in out.stdout, out.stderr[-2000:]


def test_kneser_ney_merge_memory():
    import tracemalloc

    import pandas as pd

    rng, rows, want, n = np.random.default_rng(4), [], Counter(), 0
    for _ in range(4):
        at = rng.integers(0, 60, (50_000, 3)) + (1 << 31)  # v, u, w
        at, c = np.unique(at, axis=0, return_counts=True)
        want.update(dict(zip(map(tuple, at.tolist()), c.tolist(), strict=True)))
        n += len(at)
        rows.append([kneser_ney.planes(x, "<u4") for x in (at[:, 1], np.diff(at[:, 0], prepend=0), at[:, 2], c)])
    rows = pd.DataFrame(rows, columns=["u", "v", "w", "c"])
    tracemalloc.start()
    u, v, w, c = kneser_ney.merged(rows, "<u4")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(zip(v.tolist(), u.tolist(), w.tolist(), strict=True)) == sorted(want)
    assert dict(zip(zip(v.tolist(), u.tolist(), w.tolist(), strict=True), c.tolist(), strict=True)) == want
    assert c.dtype == np.int64 and peak < 56 * n  # three ids and a count of eight bytes each, twice, were 64 and more


def test_kneser_ney_search(tmp_path):
    from tenement.llm import kneser_ney as K

    class Counted(np.ndarray):
        gathers = 0

        def __getitem__(self, at):
            Counted.gathers += isinstance(at, np.ndarray)
            return super().__getitem__(at)

    draw = np.random.default_rng(4)
    for kind in ("u1", "u2", "i8"):
        parts = [np.unique(draw.integers(0, 256, n)) for n in (200, 0, 3, 90, 1)]
        a, ends = np.concatenate(parts).astype(kind), np.cumsum([len(p) for p in parts])
        which = np.sort(draw.integers(0, 5, 300))
        x = draw.integers(-1, 300, 300)  # some are no value of the type
        low, high = (ends - [len(p) for p in parts])[which], ends[which]
        want = [next((i for i in range(p, q) if a[i] == y), -1) for p, q, y in zip(low, high, x, strict=True)]
        assert K.search(a, low, high, x).tolist() == want and K.search(a, low[:0], high[:0], x[:0]).tolist() == []
        assert K.search(a, low[::-1], high[::-1], x).tolist() == [next((i for i in range(p, q) if a[i] == y), -1) for p, q, y in zip(low[::-1], high[::-1], x, strict=True)]
    a = np.arange(0, 200_000, 2, dtype=np.uint32).view(Counted)
    assert (K.search(a, np.zeros(500, np.int64), np.full(500, len(a)), np.arange(0, 1000, 2)) == np.arange(500)).all() and Counted.gathers == 1  # one for all, not one a halving
    assert type(K.Files()(K.save(str(tmp_path), {"x": np.arange(3)}), "x")) is np.ndarray


def plain_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_license_base_columns(spark, docs):
    more = ["cc by cc by", "general public license general public license all rights reserved", "CC-BY all  rights\nreserved", "cc " * 50 + "by", "all rights", "x" * 70000 + " cc by"]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(50 + i, t) for i, t in enumerate(more)] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    text = dict(rows)
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licenses(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_table_of_templates(spark):
    whole = " ".join(f"clause{i}" for i in range(300))
    table = spark.createDataFrame([("long-1.0", whole), ("long-1.0", None), (None, "a b c")], "label string, text string")
    cut = " ".join(w for i, w in enumerate(whole.split()) if i % 40)
    docs = spark.createDataFrame([(1, f"x y {whole} z"), (2, cut), (3, " ".join(whole.split()[:60])), (4, "cc by")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, templates=table, drift=20).collect()}
    assert got[1].labels == got[2].labels == "long-1.0" and got[3].labels == "" and got[4].labels == "cc-by"


def plain_labels(text, coverage=0.6, drift=2):
    """Labels and score by all windows of all merged runs of diagonals."""
    w = decontaminate_words(text)
    labels, score = set(), 0.0
    for line, label, is_base in [(p, x, True) for p, x in licenses.BASE.items()] + [(t, x, False) for x, ts in licenses.TEMPLATES.items() for t in ts]:
        t = line.split()
        hits = sorted((i - j, i, j) for i in range(len(w) - 1) for j in range(len(t) - 1) if w[i:i + 2] == t[j:j + 2])
        runs = []
        for h in hits:
            if not runs or h[0] - runs[-1][-1][0] > (0 if is_base else drift):
                runs.append([])
            runs[-1].append(h)
        for run in runs:
            width = 2 * (len(t) - 1)
            share = max(len({j for _, i, j in run if a <= i < a + width}) for _, a, _ in run) / (len(t) - 1)
            if share == 1 or (not is_base and share >= coverage):
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


def test_license_labels_brute_force(spark):
    """Labels and scores on edited, repeated and chained licence lines, the example of a line that later text once erased among them."""
    rng = random.Random(5)
    lines = [t for ts in licenses.TEMPLATES.values() for t in ts] + list(licenses.BASE)
    texts = ["released under the mit license", "released under the mit license mit license mit license mit license", "mit license " * 400 + "released under the mit license " + "the mit " * 300, "of the of the", "", None]
    for _ in range(150):
        w = []
        for _ in range(rng.randrange(1, 6)):
            part = rng.choice(lines).split()
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(part))
                part[at:at + 1] = rng.choice([[], [part[at], "so"], part[:at], [part[at], part[at]]]) or ["x"]
            w += part * rng.randrange(1, 3)
        texts.append(" ".join(w))
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == got[1] == got[2] == ("mit", 1.0) and got[3] == ("", 0.0)
    for i, t in enumerate(texts):
        want = plain_labels(t)
        assert got[i][0] == want[0] and abs(got[i][1] - want[1]) < 1e-12, t


def test_quality_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 0.25, 3, "q"), (2, None, None, None, None)], "doc_id long, text string, quality_score double, _w int, f_n_chars string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    import corpus_pipeline

    out = quality.scored(docs, labels)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == 2
    corpus_quality = corpus_pipeline.scored(docs.withColumnRenamed("quality_score", "kept"), labels).where("quality_score >= 0.5")
    assert corpus_quality.select("kept", "_w", "f_n_chars").collect()[0] == (0.25, 3, "q")


def test_quality_fit_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 10))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=3000) > 0).astype(float)
    tracemalloc.start()
    rules, _, _ = quality.fit_rules(x, y, steps=1, penalty=0.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rules) > 200 and peak < 1.7 * 8 * len(y) * len(rules)  # one matrix of rows by rules, no copy


def test_quality_train_memory(spark, monkeypatch):
    import tracemalloc

    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sizes = []
    monkeypatch.setattr(quality, "fit_rules", lambda x, y: sizes.append((x.shape, y.shape)) or ([], np.zeros(0), 0.0))
    quality.train(docs.limit(10), labels)
    tracemalloc.start()
    quality.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    (n, columns), _ = sizes[-1]
    assert 15000 < n <= 20000 and columns == len(quality.FEATURES)
    assert peak < 8e6  # two copies of the numbers take 4 MB; rows of Python objects several times that


def test_quality_filter_repeats_no_statistics(spark):
    docs = spark.createDataFrame([(i, f"{'A' * (i % 7)} b {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 > 3)) for i in range(200)], "doc_id long, quality int")
    every = quality.scored(docs, labels)
    kept = every.where("quality_score >= 0.5").drop("quality_score")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("f_upper") >= 1
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in every.collect() if r.quality_score >= 0.5}


def test_quality_repeated_rows(spark):
    """Rows of a labelled id that repeat count once, however many there are; very long texts are scored whole."""
    rows = [(i, "plain good words stand here" if i % 2 else "!!! ### $$$") for i in range(60)] + [(70, "long words " * 200_000), (71, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(5, None)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = docs.union(docs.where("doc_id < 4").crossJoin(spark.range(3000)).select("doc_id", "text"))
    once, again = quality.train(docs, labels), quality.train(many, labels)
    assert once[0] == again[0] and list(once[1]) == list(again[1]) and once[2] == again[2]
    score = {r.doc_id: r.quality_score for r in quality.scored(many, labels).distinct().collect()}
    assert score[1] > 0.5 > score[0] and set(score) == {r[0] for r in rows} and all(0 <= v <= 1 for v in score.values())
    versions = spark.range(500).selectExpr("2L as doc_id", "concat('!!! ', id) as text")
    assert len(quality.train(docs.union(versions), labels, bound=50)) == 3


def test_toxicity_words():
    assert toxicity.words_of("Ab " + "x" * 200 + " don't") == ["ab", "x" * 200, "don't"] and toxicity.words_of(None) == []
    assert toxicity.words_of("日本語 abc한국어") == ["日", "本", "語", "abc한국어"]
    w = "<" + "abcd" * 90 + ">"
    assert toxicity.pieces("abcd" * 90) == {zlib.crc32(p.encode()) % toxicity.BUCKETS for p in {w} | {w[i:i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)}}


def test_toxicity_rows(spark):
    rows = [(i, f"plain words about topic {i % 7}" if i % 2 else f"you horrid topic {i % 7}", "en", 0.9, 1) for i in range(60)]
    rows += [(3, rows[3][1], "en", 0.9, 1)] * 3 + [(90, None, None, None, None), (91, "", None, None, None), (None, "you horrid topic 3", None, None, None), (92, "you h0rridd topic 1", None, None, None), (93, "plain " * 50_000 + "w" * 100_000, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, toxic int")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)] + [(4, 1), (None, 1), (90, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == 3}) == 1
    assert score[90] == score[91] < 0.5 and score[92] >= 0.5 and score[None] >= 0.5 and score[93] < 0.5
    assert sorted((r.score, str(r.doc_id)) for r in got) == sorted((r.score, str(r.doc_id)) for r in toxicity.scored(docs, labels).collect())
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_temporary(spark):
    import os

    from tenement.llm.common import cut, shared_dir, temporary, written

    shared_dir(spark)
    kept = cut(spark.range(5))
    with temporary(spark):
        path = shared_dir(spark).removeprefix("file:")
        inside = written(cut(spark.range(7)), "inside")
        assert inside.count() == 7 and os.listdir(path)
    assert not os.path.exists(path) and kept.count() == 5 and cut(spark.range(3)).count() == 3
    assert os.path.dirname(shared_dir(spark).removeprefix("file:")) == os.path.dirname(os.path.dirname(path))


def test_toxicity_beats_majority(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.op7_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r.score for r in got if r.toxic == 1], [r.score for r in got if r.toxic == 0]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.75 and sum(a >= 0.5 for a in toxic) >= 0.5 * len(toxic) and sum(b >= 0.5 for b in clean) <= 0.05 * len(clean)


def test_near_links_in_blocks(spark, monkeypatch):
    import random

    from tenement.llm import neardup

    draw = random.Random(2)
    base = [f"v{i}" for i in range(200)]
    texts = {k: " ".join("z" if draw.random() < 0.014 else w for w in base) for k in range(50)}
    sets = {k: set(neardup.shingles(t).tolist()) for k, t in texts.items()}
    monkeypatch.setattr(neardup, "FEW", 3)
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 8)
    links = {(r.u, r.v) for r in neardup.similar_links(spark.createDataFrame(list(texts.items()), "key long, text string")).collect()}
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in links)
    root = {k: k for k in texts}
    for _ in texts:
        root = {i: min(root[j] for j in texts if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in texts}
    found = {r.u: r.root for r in simhash.components(spark.createDataFrame(list(links), "u long, v long")).collect()}
    assert {k: found.get(k, k) for k in texts} == root


def test_classifiers(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.op5_quality(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    got = toxicity.op7_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.9 * len(got)
    empty = labels.limit(0)
    assert {r.quality_score for r in quality.scored(d.limit(3), empty).collect()} == {0.5}
    assert {r.score for r in toxicity.scored(d.limit(3), empty).collect()} == {0.5}
