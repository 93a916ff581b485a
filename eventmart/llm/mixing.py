"""Operator 5: mix sources to target weights, with DataFrame functions only.

The words of a source are one stream, in order of doc_id, cut into blocks of the
same number of words, fewer for sources of which few are taken; a document lies in one block or spans several. The mix is drawn
in slots of one block each. A slot falls into one output shard by its hash, so
the counts of sources in a shard are a multinomial draw whose totals are the targets.
Slot i of a source (counted over the shards, by a prefix sum of the drawn counts)
takes block ``perm(i mod blocks)`` of pass ``i div blocks``, where perm is a
pseudorandom permutation of the source and the pass. Joining slots and documents by
block gives what each document contributes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import small, staged, width

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, at most. A target is made of so many blocks at least, which brings what is taken to
#: within half a block of it, unless that gives a source more than the most blocks.
BLOCK_WORDS, LEAST_SLOTS, MOST_BLOCKS = 256, 256, 1 << 22
#: Slots of an output shard.
SHARD_SLOTS = 4096
#: Weights of sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Of all words, how many the mix takes; and how often a source may be repeated.
SHARE, LIMIT = 1.5, 2.0
#: Primes above any number of blocks of a source; each is prime to that number.
PRIMES = (2_147_483_659, 2_147_483_693, 2_147_483_713, 2_147_483_743, 2_147_483_777, 2_147_483_783, 2_147_483_813, 2_147_483_857)


@dataclass
class Mix:
    """``docs``: the documents with their place in their source's stream; ``segments``: the words each has in a block;
    ``slots``: shard, slot and the block it takes; ``sources``: sizes and targets."""

    docs: DataFrame
    segments: DataFrame
    slots: DataFrame
    sources: DataFrame


def sizes_in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size, start): the place of every document in the stream of its source.

    A prefix sum in two steps: rows are dealt out by ranges of (source, doc_id), so a large
    source spans many of them; sums within a range, then over the ranges.
    Rows that are alike in doc_id, source, size and text are interchangeable.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64("text").alias("text_hash"))
    rows = rows.repartitionByRange(width(docs.sparkSession), F.col("source").asc_nulls_last(), "doc_id", "text_hash")
    rows = staged(rows.withColumn("part", F.spark_partition_id()), "sizes")
    own = Window.partitionBy("source", "part").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    parts = staged(parts.select(F.col("source").alias("_s"), F.col("part").alias("_p"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")), "bases")
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    placed = placed.join(small(parts), F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p")))
    return staged(placed.select("doc_id", "source", "text_hash", "size", (F.col("base") + F.col("within")).alias("start")), "placed")


def targets(placed: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) of every source.

    Sources in order of code points, nulls last, weigh ``weights`` in turn. Targets share
    ``share`` times all words by weight; one above ``limit`` times its source stops there and
    the excess goes to the others by weight, until none is above. With sources
    ordered by size over weight, the capped ones come first: source k is capped if
    its limit is at most its share of what the sources before it leave. All of that is
    one pass of windows over one row per source.
    """
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int"))
    every = Window.partitionBy()
    sources = sources.withColumn("weight", weight).withColumn("total", share * F.sum("source_size").over(every)).withColumn("all_weights", F.sum("weight").over(every))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - limit * F.coalesce(F.sum("source_size").over(by_need), F.lit(0))
    weights_left = F.col("all_weights") - F.coalesce(F.sum("weight").over(by_need), F.lit(0.0))
    sources = sources.withColumn("level", left / weights_left)
    sources = sources.withColumn("capped", limit * F.col("source_size") <= F.col("weight") * F.col("level"))
    level = F.coalesce(F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), "level"))).over(every)["level"], F.lit(0.0))
    target = F.when(F.col("capped"), limit * F.col("source_size")).otherwise(F.col("weight") * level)
    return staged(sources.select("source", "source_size", target.alias("target")), "targets")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def fitted(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``sources`` with the words of a block of each, ``block`` at most."""
    fine = F.floor(F.col("target") / LEAST_SLOTS).cast("long")
    least = F.ceil(F.col("source_size") / MOST_BLOCKS).cast("long")
    return sources.withColumn("block_words", F.least(F.lit(block).cast("long"), F.greatest(fine, least, F.lit(1).cast("long"))))


def draw(sources: DataFrame, block: int = BLOCK_WORDS, shard: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """(shard, slot, source, block): what every slot of the mix takes.

    A source has as many slots as bring its words nearest to its target, and at most
    its limit. Its blocks have ``block_words`` words where ``sources`` says so, else ``block``.
    All is hashing of names and numbers, so reruns agree.
    """
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / (F.col("block_words") if "block_words" in sources.columns else block))
    sources = sources.filter("source_size > 0").withColumn("blocks", blocks)
    # a whole pass takes every word of the source once
    slots = F.round(F.col("target") / (F.col("source_size") / F.col("blocks"))).cast("long")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("slots", slots).withColumn("end", F.sum("slots").over(order)).withColumn("no", F.row_number().over(order))
    sources = staged(sources.select("source", "blocks", "slots", "end", "no"), "slots")
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))

    # the draw: each slot of a source falls into a shard at random
    steps = sources.select("no", "slots", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / 65_536))).alias("step")).filter("slots > 0")
    steps = steps.repartition(width(spark), "no", "step")
    last = F.least(F.col("slots"), (F.col("step") + 1) * 65_536) - 1
    drawn = steps.select("no", F.explode(F.sequence(F.col("step") * 65_536, last)).alias("i"))
    counts = drawn.groupBy(F.pmod(F.xxhash64(F.lit(seed), "no", "i"), F.lit(shards)).alias("shard"), "no").agg(F.count("*").alias("n"))
    counts = staged(counts, "counts")
    before = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    taken = counts.join(small(sources), "no").select("shard", "no", "source", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("i"))
    turn, at = F.floor(F.col("i") / F.col("blocks")), F.col("i") % F.col("blocks")
    key = F.xxhash64(F.lit(seed), F.lit("pass"), "no", turn)
    prime = F.element_at(F.array(*map(F.lit, PRIMES)), (F.pmod(key, F.lit(len(PRIMES))) + 1).cast("int"))
    shift = F.pmod(F.xxhash64(key), "blocks")
    block_no = (at * F.pmod(prime, "blocks") + shift) % F.col("blocks")
    return taken.select("shard", F.xxhash64("shard", "no", "i").alias("slot"), "source", block_no.alias("block"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> Mix:
    """Plan the mix of ``docs`` (doc_id, text, source; other columns are ignored).

    A null source is a source of its own, the last. Null and empty texts have no words
    and take no part. Repeated rows count as often as they occur.
    """
    placed = sizes_in_order(docs)
    sources = staged(fitted(targets(placed), block), "fitted")
    per = F.col("block_words")
    sized = placed.filter("size > 0").join(small(sources.select(F.col("source").alias("_s"), "block_words")), _same("source", "_s"))
    first, end = F.floor(F.col("start") / per), F.floor((F.col("start") + F.col("size") - 1) / per)
    spans = sized.select("source", "doc_id", "start", "size", "block_words", F.explode(F.sequence(first, end)).alias("block"))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * per) - F.greatest(F.col("start"), F.col("block") * per)
    segments = spans.select("source", "block", "doc_id", "start", words.alias("words"))
    return Mix(placed, segments, draw(sources, block, seed=seed), sources)


def mixed_words(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, text_hash) of every document; ``taken`` counts repeats."""
    plan = mix(docs, block, seed)
    picks = plan.slots.groupBy("source", "block").agg(F.count("*").alias("picks"))
    picks = picks.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "picks")
    used = plan.segments.join(picks, _same("source", "_s") & (F.col("block") == F.col("_b")))
    # (source, start) names a document that has words
    used = used.groupBy(F.col("source").alias("_s"), F.col("start").alias("_t")).agg(F.sum(F.col("words") * F.col("picks")).alias("taken"))
    sources = small(plan.sources).withColumnsRenamed({"source": "_n"})
    out = plan.docs.join(used, _same("source", "_s") & (F.col("start") == F.col("_t")) & (F.col("size") > 0), "left")
    out = out.join(sources, _same("source", "_n"))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source", "text_hash")


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, whole: taken / size, rounded up or down by a hash.

    A row the mix doesn't reach is gone; one of a source that is repeated may occur twice.
    Rows alike in doc_id, source and text share what they have together.
    """
    words = mixed_words(docs, block, seed).groupBy("doc_id", "source", "text_hash")
    words = words.agg((F.sum("taken") / F.sum("size")).alias("times")).filter("times > 0")
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.lit(1 << 20)) / (1 << 20)
    words = words.select(F.struct("doc_id", "source", "text_hash").alias("_key"), F.floor(F.col("times") + chance).alias("_times"))
    words = small(staged(words.filter("_times > 0"), "times"))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_hash"))
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"), key.alias("_own"))
    return rows.join(words, F.col("_own").eqNullSafe(F.col("_key"))).select("_row", F.explode(F.sequence(F.lit(1), "_times"))).select("_row.*")
