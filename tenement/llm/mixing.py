"""Mixing sources to target weights by permuted blocks. Column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table, workers

WEIGHTS = (5.0, 2.0, 1.0)
REPEAT = 3
STEP = 4096
SEED = 17
FEW = 100_000
BLOCK = 64
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """source, source_size -> + target. One row per source, so the ordered windows see sources only.

    Closed form of resharing: in order of size / weight the first sources are held at ``repeat`` times their size and the
    others share the rest by weight.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    s = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(repeat))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    s = s.withColumn("at", F.row_number().over(order))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("at", "level"))
    s = s.withColumn("level", F.min(fits).over(Window.partitionBy())["level"]).drop("at")
    return s.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))).drop("level", "cap", "weight")


def few(sources: DataFrame) -> DataFrame:
    """The table of sources, broadcast up to FEW rows."""
    return F.broadcast(sources) if sources.count() <= FEW else sources


def packed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Place every document in its source's token stream: start (exclusive sum of sizes) and block length.

    The stream is cut in hashed chunks of about STEP documents; chunk sums are added up first, so no task sees a whole source.
    """
    s = few(sources).withColumnRenamed("source", "s").withColumn("chunks", F.greatest(F.lit(1), F.col("n_docs") / STEP).cast("long"))
    placed = sized.where("size > 0").join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "row_hash", "nth"), F.col("chunks")))
    sums = placed.groupBy("sid", "chunk").agg(F.sum("size").alias("chunk_size"))
    above = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "chunk", F.coalesce(F.sum("chunk_size").over(above), F.lit(0)).alias("base"))
    inner = Window.partitionBy("sid", "chunk").orderBy("doc_id", "row_hash", "nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("size").over(inner))
    return placed.join(sums, ["sid", "chunk"]).withColumn("start", F.col("base") + F.col("upto") - F.col("size"))


def permuted(index, count, salt, rounds: int = 8):
    """Pseudorandom permutation of [0, count): swap-or-not rounds, any count."""
    keys = F.array(*[F.lit(r) for r in range(rounds)])

    def step(x, r):
        other = F.pmod(F.pmod(F.xxhash64(salt, r), count) - x, count)
        return F.when(F.pmod(F.xxhash64(salt, r + 1000, F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(keys, index, step)


def shard_counts(sources: DataFrame, shard_slots: int = STEP) -> DataFrame:
    """shard, sid, first, count: slots that each source gets in each output shard, and the first one's place in its shard. ``sources``: sid, slots.

    A multinomial draw per shard: every slot draws a source by itself, with a chance of the source's share in all ``slots``. The drawn number is looked up
    by its spot, one of at least STEP equal stretches of the cumulative sum, so that no slot meets all sources and no spot is hot.
    """
    spark = sources.sparkSession
    total, n = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    width, n_shards = max(1, -(-total // max(STEP, n))), -(-total // shard_slots)
    high = F.sum("slots").over(Window.orderBy("sid"))  # one row per source
    spots = sources.withColumn("high", high).where("slots > 0").withColumn("low", F.col("high") - F.col("slots"))
    spots = spots.select("sid", "low", "high", F.explode(F.expr(f"sequence(low div {width}L, (high - 1) div {width}L)")).alias("spot"))
    shards = spark.range(0, n_shards, 1, max(1, min(n_shards, workers(spark)))).withColumnRenamed("id", "shard")
    draws = shards.select("shard", F.explode(F.expr(f"sequence(0L, least({shard_slots}L, {total}L - shard * {shard_slots}L) - 1)")).alias("k"))
    draws = draws.select("shard", F.pmod(F.xxhash64(F.lit(SEED + 1), "shard", "k"), F.lit(max(total, 1)).cast("long")).alias("at")).withColumn("spot", F.expr(f"at div {width}L"))
    counts = draws.join(few(spots), "spot").where("low <= at and at < high").groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("count"))
    before = Window.partitionBy("shard").orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)  # at most shard_slots rows
    return counts.select("shard", "sid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"), "count")


def slots(sources: DataFrame) -> DataFrame:
    """shard, position, sid, block, most: one row per output slot. The slots that the shards drew from a source are numbered through; slot j takes
    block j of the source's permutation, a new one per pass, a shorter last block at the end of each pass. ``most`` words of it are taken: all but in
    a source's last slot, which ends at its target.

    What a source drew above its ``slots`` goes to the sources that drew fewer, about the square root of all slots in number. Shards are numbered
    through in groups of STEP whose sums are added up first, so no task sees all shards of a source.
    """
    drawn = cut(shard_counts(sources).withColumn("group", F.expr(f"shard div {STEP}")))
    above = Window.partitionBy("sid").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut(drawn.groupBy("sid", "group").agg(F.sum("count").alias("n")))
    base = sums.select("sid", "group", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("base"))
    inner = Window.partitionBy("sid", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("upto", F.coalesce(F.sum("count").over(inner), F.lit(0))).join(base, ["sid", "group"]).withColumn("number", F.col("base") + F.col("upto"))

    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    totals = sources.select("sid", "slots", "n_blocks", "source_size", "length", "goal").join(sums.groupBy("sid").agg(F.sum("n").alias("got")), "sid", "left").na.fill(0, ["got"])
    for name, diff in (("over", F.col("got") - F.col("slots")), ("under", F.col("slots") - F.col("got"))):
        totals = totals.withColumn(name, F.coalesce(F.sum(F.greatest(diff, F.lit(0))).over(before), F.lit(0)))
    totals = cut(totals)

    numbered = cut(drawn.repartition(workers(sources.sparkSession), "sid", "shard").join(few(totals.select("sid", "slots", "over")), "sid"))
    own = numbered.where("number < slots").select("sid", "shard", "first", "number", F.explode(F.expr("sequence(0L, least(count, slots - number) - 1)")).alias("k"))
    own = own.select("sid", (F.col("number") + F.col("k")).alias("slot"), "shard", (F.col("first") + F.col("k")).alias("position"))
    spare = numbered.where("number + count > slots").select("shard", "first", "number", "slots", "over", F.explode(F.expr("sequence(greatest(0L, slots - number), count - 1)")).alias("k"))
    spare = spare.select((F.col("over") + F.col("number") + F.col("k") - F.col("slots")).alias("nth"), "shard", (F.col("first") + F.col("k")).alias("position"))
    short = totals.where("got < slots").select("sid", "got", "under", F.explode(F.expr("sequence(got, slots - 1)")).alias("slot"))
    short = short.select("sid", "slot", (F.col("under") + F.col("slot") - F.col("got")).alias("nth"))
    every = own.unionByName(short.join(spare, "nth").drop("nth")).join(few(totals.select("sid", "n_blocks", "source_size", "length", "goal")), "sid")

    every = every.withColumn("pass", F.expr("slot div n_blocks")).withColumn("i", F.expr("slot % n_blocks")).withColumn("full", F.expr("source_size div length"))
    at = permuted(F.col("i"), F.greatest(F.col("full"), F.lit(1)), F.xxhash64(F.lit(SEED), "sid", "pass"))
    most = F.least(F.col("length"), F.col("goal") - F.col("pass") * F.col("source_size") - F.col("i") * F.col("length"))
    return every.select("shard", "position", "sid", F.when(F.col("i") < F.col("full"), at).otherwise(F.col("i")).alias("block"), most.alias("most"))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The rows with their sizes and the sources with targets, blocks of ``block`` words (a source's last one may be shorter) and output slots: every
    full pass over a source takes all its blocks, the last pass as many as its target asks for."""
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text, "source").alias("row_hash"))
    sized = sized.groupBy("doc_id", "source", "row_hash", "size").agg(F.count(F.lit(1)).alias("rows"))
    sized = sized.withColumn("part", F.explode(F.expr(f"sequence(0L, (rows - 1) div {STEP})")))  # two steps: no array of all repeats
    sized = cut(sized.select("doc_id", "source", "size", "row_hash", F.explode(F.expr(f"sequence(part * {STEP} + 1, least(rows, (part + 1) * {STEP}))")).alias("nth")))
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, repeat)
    sources = sources.withColumn("length", F.lit(block).cast("long")).withColumn("n_blocks", F.expr("(source_size + length - 1) div length"))
    sources = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))  # one row per source
    sources = sources.withColumn("goal", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * repeat).cast("long"))
    return sized, cut(sources.withColumn("slots", F.expr("if(source_size = 0, 0L, goal div source_size * n_blocks + (goal % source_size + length - 1) div length)")))


def pieces(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """doc_id, row_hash, nth, sid, block, from_word, words: the stretches of documents that make up the blocks of each source."""
    placed = packed(sized, sources).withColumn("block", F.explode(F.expr("sequence(start div length, (start + size - 1) div length)")))
    begin = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length")) - begin
    return placed.select("doc_id", "row_hash", "nth", "sid", "block", (begin - F.col("start")).alias("from_word"), (begin - F.col("block") * F.col("length")).alias("at"), words.alias("words"))


def mixed_blocks(docs: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT, block: int = BLOCK) -> DataFrame:
    """shard, position, source, block, tokens: the mix itself, one row per output slot, by a join of slots and blocks on the block's index.

    A source's last block and the last one that is taken of it may be shorter. Rows and sources as in ``mix``.
    """
    sized, sources = plan(docs, weights, repeat, block)
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64(text, "source").alias("h"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w")).dropDuplicates(["d", "h"])
    part = pieces(sized, sources).join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_hash") == F.col("h")))
    part = part.select("sid", "block", F.struct("at", F.expr("slice(w, cast(from_word + 1 as int), cast(words as int))").alias("w")).alias("p"))
    blocks = part.groupBy("sid", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["w"])).alias("tokens"))
    named = few(sources.select("sid", "source"))
    mixed = slots(sources).join(blocks.hint("merge"), ["sid", "block"]).join(named, "sid")
    return mixed.select("shard", "position", "source", "block", F.expr("slice(tokens, 1, cast(most as int))").alias("tokens"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row: what ``mixed_blocks`` takes, without its tokens.

    Sizes count words; null text is size 0; null source is a source of its own, last. Equal rows are told apart only by
    position and may be taken unequally. Empty tables give no rows. Further columns are ignored. Taken words of a source add up to its
    target, rounded.
    """
    sized, sources = plan(docs, weights, repeat, block)
    times = slots(sources).groupBy("sid", "block", "most").agg(F.count(F.lit(1)).alias("times"))
    words = F.greatest(F.lit(0), F.least(F.col("words"), F.col("most") - F.col("at"))) * F.col("times")
    taken = pieces(sized, sources).join(times.hint("merge"), ["sid", "block"]).groupBy("doc_id", "row_hash", "nth").agg(F.sum(words).alias("taken"))
    taken = taken.withColumnsRenamed({"doc_id": "d", "row_hash": "h", "nth": "m"})
    out = sized.join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_hash") == F.col("h")) & (F.col("nth") == F.col("m")), "left")
    named = few(sources.select(F.col("source").alias("s"), "source_size", "target"))
    return out.join(named, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
