"""Document fingerprints from closed syncmers. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, workers

# Scripts written without blanks: each of their characters is a unit.
LONE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
CUT = "aeiouAEIOU02468аеиоуыэюя"
UNIT = rf"[{LONE}]|(?<!\S)[\S&&[^{LONE}]]{{1,12}}+(?!\S)|[\S&&[^{LONE}{CUT}]]{{0,11}}[{CUT}]|[\S&&[^{LONE}]]{{1,12}}"
EDGE = -(1 << 63)
BROADCAST_ROWS = 2_000_000


def units(text: Column) -> Column:
    """Hashes of a text's units, the same for all lengths: words, those of over 12 characters cut after characters of CUT, so that
    an edit moves the cuts near it only; two edge marks at both ends, so that one word is enough for a run of three."""
    marks = F.array(F.lit(EDGE), F.lit(EDGE))
    pieces = F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))
    return F.when(text.rlike(r"\S"), F.concat(marks, F.transform(pieces, lambda w: F.xxhash64(w)), marks)).otherwise(F.expr("cast(array() as array<bigint>)"))


def with_syncmers(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add array<struct<at,hash>>: every run of three units whose least unit is the first or the last one.

    The units are a column of their own, so that they are not evaluated again for each element.
    """
    def mer(x: Column, i: Column) -> Column:
        y, z = F.get("_h", i + 1), F.get("_h", i + 2)
        edge = ((x <= y) & (x <= z)) | ((z <= x) & (z <= y))
        return F.when(edge, F.struct(i.alias("at"), F.xxhash64(x, y, z).alias("hash")))

    df = df.withColumn("_h", units(F.col(text)))
    return df.withColumn(out, F.filter(F.transform("_h", mer), lambda m: m.isNotNull())).drop("_h")


def with_print(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add array<int>, the fingerprint: for every syncmer a hash of it and of its distance to the one before, so that equal stretches
    match by content and inner positions wherever they stand in a text. No syncmer is left out."""
    def element(m: Column, i: Column) -> Column:
        return F.hash(m["hash"], m["at"] - F.coalesce(F.get("_s", i - 1)["at"], m["at"]))

    return with_syncmers(df, text, "_s").withColumn(out, F.transform("_s", element)).drop("_s")


def written_out(elements: Column) -> Column:
    """The fingerprint as text, 8 hex digits an element in the order of the text."""
    return F.array_join(F.transform(elements, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints; 1 if both are empty."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / every).cast("double")


def ranges(ids: DataFrame) -> tuple[Column, dict[int, int]]:
    """The range of a doc_id as a column, and the least doc_id of every range that has rows (a few per worker)."""
    n = 16 * workers(ids.sparkSession)
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    under = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    column = F.lit(0)
    if groups:
        group = under(F.array(*[F.lit(g[0]) for g in groups])) - 1
        column = F.when(group < 0, 0).otherwise(group * step + under(F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group)))
    least = {r.part: r.least for r in ids.groupBy(column.alias("part")).agg(F.min("doc_id").alias("least")).collect()}
    return column, dict(sorted(least.items()))


def _few(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, print, next_text, next_print, edited of every row. The next text is the least one of the next doc_id (a whole
    number); a null doc_id has none: its edited text only loses the tail. Null text counts as empty.

    Texts are dealt out once, by ranges of doc_id; each range also gets the first document of the next one. Of an id
    with several rows one row stands in the line, and all its rows get what follows it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = docs.where("doc_id is not null")
    ids = known.select("doc_id")
    part, least = ranges(ids)
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    n_several = several.count()
    line = known
    if n_several:
        several = _few(several, n_several)
        held = known.join(several, "doc_id", "left_semi")
        line = known.join(several, "doc_id", "left_anti").unionByName(held.groupBy("doc_id").agg(F.min("text").alias("text")))
    line = line.withColumn("part", part).withColumn("guest", F.lit(False))
    parts = list(least)
    guests = [(least[parts[(i + 1) % len(parts)]], p) for i, p in enumerate(parts)]
    guests = F.broadcast(spark.createDataFrame(guests, "doc_id long, part int"))
    guests = line.drop("part", "guest").join(guests, "doc_id").withColumn("guest", F.lit(True))
    dealt = line.unionByName(guests).repartition(workers(spark), "part")
    order = Window.partitionBy("part").orderBy("guest", "doc_id")
    marked = with_print(dealt, "text", "print")
    marked = marked.withColumn("next_text", F.lead("text").over(order)).withColumn("next_print", F.lead("print").over(order)).where("not guest").drop("part", "guest")
    if n_several:
        info = marked.join(several, "doc_id", "left_semi").select("doc_id", "next_text", "next_print")
        marked = marked.join(several, "doc_id", "left_anti").unionByName(with_print(held, "text", "print").join(info, "doc_id"))
    lone = with_print(docs.where("doc_id is null"), "text", "print").withColumn("next_text", F.lit(None).cast("string")).withColumn("next_print", F.lit(None).cast("array<int>"))
    rows = marked.unionByName(lone)
    tail = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.char_length("text") - tail), F.coalesce(F.col("next_text").substr(F.lit(1), tail), F.lit("")))
    return rows.withColumn("edited", edited)


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = with_print(edited_texts(table(spark, sf_dir, "documents")), "edited", "edited_print")
    return texts.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        written_out(F.col("print")).alias("fingerprint"), written_out(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                        F.when(F.col("next_print").isNull(), 0.0).otherwise(likeness(F.col("print"), F.col("next_print"))).alias("near_next"))
