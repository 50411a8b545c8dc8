"""Personal data: base entities by pattern, further identifiers by bootstrapped lexical contexts. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table

KINDS = ("email", "ip", "card", "phone")
# A match starts where a run of its first class starts, or where the last match ended: any later start in a failed run fails too.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?![0-9])"
# A word with a digit, or whatever is assigned to a name.
MENTION = r"""(?:\G|(?<![A-Za-z0-9._/+-]))[A-Za-z._/+-]*+[0-9][A-Za-z0-9._/+-]*+|(?<=[=:] {0,1}["']{0,1})[A-Za-z][A-Za-z._/+-]*+"""
SECRET = "^[0-9A-Fa-f]{32,}$"
FEW = 1_000_000


def running(values: Column, step, first: int = 0) -> Column:
    """``step`` folded up to each element of an array of longs: chunks of about the square root of its length first, so that no array grows by one
    element at a time to the whole length."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values)))).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), size), lambda i: F.slice(values, i + 1, size))
    none = F.expr("cast(array() as array<bigint>)")

    def fold(a: Column) -> Column:
        start = F.struct(F.lit(first).cast("long").alias("at"), none.alias("out"))
        return F.aggregate(a, start, lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(step(acc["at"], x))).alias("out")), lambda acc: acc["out"])

    inner = F.transform(chunks, fold)
    before = fold(F.transform(inner, lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(first).cast("long"))))
    # Pairs and no look-ups: what a lambda reads from outside may be worked out again for each element.
    return F.flatten(F.zip_with(inner, _later(before, first), lambda a, b: F.transform(a, lambda x: step(b, x))))


def _later(values: Column, first: int = 0) -> Column:
    """The array moved by one place: each element meets the one before it."""
    return F.concat(F.array(F.lit(first).cast("long")), F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0))))


def _context(before: Column) -> Column:
    """The up to two words before a mention and what precedes it directly, in lower case."""
    words = F.split(before, r"\s+")
    return F.lower(F.array_join(F.slice(words, F.greatest(F.lit(1), F.size(words) - 2), F.lit(3)), " "))


def with_matches(df: DataFrame, text: str, pattern: str, out: str, needs: str, context: bool = False) -> DataFrame:
    """Add array<struct<start,end,value,pattern>> of all matches, in code points, from the gaps that a split leaves. Only texts with a match of
    ``needs`` are looked through. The parts are columns of their own, so that they are worked out once."""
    has = F.col(text).rlike(needs)
    df = df.withColumn("_h", F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)")))
    df = df.withColumn("_g", F.when(has, F.split(F.col(text), pattern, -1)).otherwise(F.expr("cast(array() as array<string>)")))
    df = df.withColumn("_l", F.zip_with(F.slice("_g", 1, F.size("_h")), "_h", lambda g, h: (F.char_length(g) + F.char_length(h)).cast("long")))
    df = df.withColumn("_e", running(F.col("_l"), lambda a, x: a + x))

    hits = F.zip_with("_h", "_e", lambda h, e: F.struct((e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("value")))
    gaps = F.transform(F.slice("_g", 1, F.size("_h")), _context if context else lambda g: F.lit(""))
    hits = F.zip_with(hits, gaps, lambda m, g: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), g.alias("pattern")))
    return df.withColumn(out, hits).drop("_h", "_g", "_l", "_e")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    step = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise((c.try_cast("int") * 2) % 10 + F.floor(c.try_cast("int") / 5).cast("int")))
    return F.aggregate(step, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def with_base(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add array<struct<kind,start,end>>: email, ip, card, phone; failing matches are dropped."""
    def digits(m: Column) -> Column:
        return F.length(_digits(m["value"]))

    rules = {
        "email": (EMAIL, "@", lambda m: F.lit(True)),
        "ip": (IP, "[0-9]", lambda m: m["value"].rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")),
        "card": (CARD, "[0-9]", lambda m: digits(m).between(13, 19) & luhn(_digits(m["value"]))),
        "phone": (PHONE, r"\+[0-9]", lambda m: digits(m).between(9, 15)),
    }
    for kind, (pattern, needs, _) in rules.items():
        df = with_matches(df, text, pattern, f"_{kind}", needs)

    def named(kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", rules[kind][2]), lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    return df.withColumn(out, F.concat(*map(named, KINDS))).drop(*(f"_{k}" for k in KINDS))


def with_inside(df: DataFrame) -> DataFrame:
    """``mention`` with ``inside``: whether it overlaps a base span, told by the furthest end of all spans that start before its end."""
    def event(m: Column, at: str, base: int) -> Column:
        value, pattern = (F.lit(None).cast("string"),) * 2 if base else (m["value"], m["pattern"])
        return F.struct(m[at].alias("at"), F.lit(base).alias("base"), m["start"].alias("start"), m["end"].alias("end"), value.alias("value"), pattern.alias("pattern"))

    both = F.concat(F.transform("base", lambda b: event(b, "start", 1)), F.transform("mention", lambda m: event(m, "end", 0)))
    df = df.withColumn("_v", F.array_sort(F.when(F.size("mention") > 0, both).otherwise(F.slice(both, 1, 0))))
    df = df.withColumn("_r", running(F.transform("_v", lambda e: F.when(e["base"] == 1, e["end"]).otherwise(F.lit(0).cast("long"))), lambda a, x: F.greatest(a, x)))
    told = F.zip_with("_v", "_r", lambda e, r: F.struct(e["base"].alias("base"), e["start"].alias("start"), e["end"].alias("end"), e["value"].alias("value"), e["pattern"].alias("pattern"), (r > e["start"]).alias("inside")))
    return df.withColumn("mention", F.filter(told, lambda m: m["base"] == 0)).drop("_v", "_r")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW else df


def confident_patterns(edges: DataFrame, confidence: float, support: int) -> DataFrame:
    """pattern, score: score the pattern-instance graph over and over. A pattern scores the mean of its instances; an instance is worth 1 if it is
    a seed, else its best confident pattern. Ends when no further pattern becomes confident: scores only grow, so there are at most as many rounds as patterns.

    ``edges``: pattern, instance, seed (0/1), each pair once. Patterns need ``support`` distinct instances. Hot patterns aggregate partially; only confident
    patterns are joined, broadcast up to FEW rows.
    """
    scored, found = edges.withColumn("w", F.col("seed").cast("double")), -1
    while True:
        patterns = scored.groupBy("pattern").agg(F.avg("w").alias("score"), F.count(F.lit(1)).alias("k")).where(F.col("k") >= support)
        good = cut(patterns.where(F.col("score") >= confidence).select("pattern", "score"))
        now = good.count()
        if now == found:
            return good
        found = now
        best = edges.join(_few(good), "pattern").groupBy("instance").agg(F.max("score").alias("best"))
        scored = cut(edges.join(_few(best), "instance", "left").withColumn("w", F.greatest(F.col("seed").cast("double"), F.coalesce("best", F.lit(0.0)))).select("pattern", "instance", "seed", "w"))


def find_pii(docs: DataFrame, confidence: float = 0.5, support: int = 3, min_length: int = 6) -> DataFrame:
    """doc_id, key (hash of the text), base, extra: arrays of kind, start, end.

    Seeds are the base entities and hexadecimal secrets. The up to two words before a seed and what precedes it directly
    are its pattern; confident patterns find unseen identifiers (``id``): words with a digit or values assigned to a name, of ``min_length`` or more
    characters. Null text counts as empty; equal rows give equal rows; null doc_id keeps its row; further columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = with_matches(with_base(rows, "text", "base"), "text", MENTION, "mention", """[0-9]|[=:] ?["']?[A-Za-z]""", context=True)
    rows = with_inside(rows.withColumn("mention", F.filter("mention", lambda m: F.length(m["value"]) >= min_length)))
    marked = cut(rows.select("doc_id", "key", "base", "mention"))
    said = marked.where(F.size("mention") > 0).select("doc_id", "key", F.explode("mention").alias("m")).select(
        "doc_id", "key", "m.start", "m.end", F.lower("m.value").alias("instance"), "m.pattern", "m.inside", F.col("m.value").rlike(SECRET).alias("secret"))
    edges = cut(said.groupBy("pattern", "instance").agg(F.max((F.col("inside") | F.col("secret")).cast("int")).alias("seed")))
    good = confident_patterns(edges.where("length(trim(pattern)) > 0"), confidence, support)
    fresh = said.where("not inside").join(_few(good), "pattern", "left").where("secret or score is not null")
    extra = fresh.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct(
        F.when(F.col("secret"), "secret").otherwise("id").alias("kind"), F.col("start"), F.col("end")))).alias("extra")).withColumnsRenamed({"doc_id": "d", "key": "k"})
    joined = marked.join(extra, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return joined.select("doc_id", "key", "base", F.coalesce("extra", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")).alias("extra"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.concat("base", "extra")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """documents with every span replaced by [KIND]; n_chars follows the text. Overlapping spans become one, named after the first."""
    d, k, sp, en = fresh(docs, "d", "k", "s", "e")
    spans = found.select(F.col("doc_id").alias(d), F.col("key").alias(k), F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias(sp))
    spans = spans.where(F.size(sp) > 0).dropDuplicates([d, k]).withColumn(en, running(F.col(f"{sp}.end"), lambda a, x: F.greatest(a, x)))
    hit = docs.join(spans, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(k)), "left")

    def piece(s: Column, before: Column) -> Column:
        return F.when(s["start"] >= before, F.concat(F.col("text").substr((before + 1).cast("int"), (s["start"] - before).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))

    rest = F.col("text").substr((F.try_element_at(en, F.lit(-1)) + 1).cast("int"), F.char_length("text"))
    clean = F.concat(F.array_join(F.zip_with(sp, _later(F.col(en)), piece), ""), rest)
    out = hit.withColumn("text", F.when(F.col(sp).isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(sp).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return out.select(*docs.columns)
