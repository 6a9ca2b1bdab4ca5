"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks.

A source's words, documents in a seeded order, are one stream, cut into
blocks of ``B`` words.  ``RESOLUTION`` blocks for every source that is not at
its cap are dealt to those sources by highest quotients, target / (2 k - 1)
for a source's k-th block.  The method never takes a block back when more are
dealt, so the mix is built in ``shards``: a shard's quota of a source is what
the source wins up to the shard's end less what it had won before.  A source
then fills its quotas with its blocks in a seeded order (an affine
permutation of the block numbers), all of them once before any comes again.
A source at its cap gives every block ``CAP`` times.

Everything is DataFrame functions.  Texts are read once, into rows of
(doc_id, source, size); a document's offset in its source's stream is a
running sum inside one of the hashed bins of the source plus the bin's own
offset, so a source with any share of the rows is never one group.  Only
tables of one row a source (and shard) meet in one task; their sorts spill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import SPACE, saved

WEIGHTS = (1, 2, 3)     # by a source's place in code point order, repeating
CAP = 3                 # times that a source, and any document, is taken at most
RESOLUTION = 1 << 14    # blocks a source, on average
SHARDS = 8              # of the mix
BIN_DOCS = 1 << 10      # documents of all sources per bin number, on average
SEED = 12
# A prime above any number of blocks: its remainder never shares a factor
# with that number, so multiplying by it permutes the block numbers.
PRIME = (1 << 61) - 1

KEY = ["known", "name"]   # a source that may be null, as two columns that are not


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One thin row a document: id, source key, size in words, seeded place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = F.col("source").cast("string")
    return docs.select(
        "doc_id", source.isNotNull().alias("known"), F.coalesce(source, F.lit("")).alias("name"),
        F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.xxhash64(text)).alias("place"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: ``source_size``, ``weight``, ``target`` and ``capped``.

    All words are shared by weight; a target above ``cap`` times its source
    stops there and what it leaves is shared anew among the others, until
    none is above.  Each round adds up one row a source and brings two
    totals to the driver; a source that is capped stays so."""
    spark = sizes.sparkSession
    by_name = Window.orderBy(F.col("known").desc(), "name")
    rows = saved(
        sizes.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.lit(list(weights)), (F.pmod(
            F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")), "sources")
    total, all_weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    left, free = total or 0, all_weights or 1
    big = lambda c, by: c.cast("decimal(20,0)") * F.lit(by).cast("decimal(18,0)")
    while True:
        over = big(F.col("source_size"), cap * free) < big(F.col("weight"), left)
        held, open_ = rows.agg(F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))).first()
        now = ((total or 0) - cap * (held or 0), open_ or 1)
        if now == (left, free):
            break
        left, free = now
    return rows.select("*", over.alias("capped"), F.when(over, F.col("source_size") * cap).otherwise(
        F.col("weight") * F.lit(float(left)) / free).cast("double").alias("target"))


def apportion(rows: DataFrame, groups: list[str], votes: str, seats: str, order: list[str]) -> DataFrame:
    """Adds ``won``: the seats of each row when ``seats`` (the same in all
    rows of a group) go to the group's rows by highest quotients, votes
    / (2 k - 1), ties by ``order``.

    With n rows, a row has at least what the divisor total / (seats - n / 2)
    gives it, rounded, and at most what total / (seats + n / 2) gives it:
    only the seats between (about two a row) are ranked by their quotients."""
    group = Window.partitionBy(*groups)
    v = F.col(votes).cast("double")
    rows = rows.withColumns({"_n": F.count("*").over(group), "_sum": F.sum(v).over(group)})
    at = lambda sign: F.floor(v * (F.col(seats) + F.lit(sign) * F.col("_n") / 2) / F.col("_sum") + 0.5)
    some = F.col("_sum") > 0
    rows = rows.withColumns({   # one more on either side makes rounding harmless
        "_low": F.when(some, F.greatest(at(-1) - 1, F.lit(0))).otherwise(0).cast("long"),
        "_high": F.when(some & (v > 0), F.greatest(at(1) + 1, F.lit(0))).otherwise(0).cast("long")})
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_low").over(group))
    kept = rows.columns
    tried = rows.withColumn("_k", F.explode_outer(F.when(
        F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high")))))
    best = Window.partitionBy(*groups).orderBy(F.desc_nulls_last("_quotient"), *order, "_k")
    tried = tried.withColumn("_quotient", v / (2 * F.col("_k") - 1)).withColumn("_nth", F.row_number().over(best))
    plain = [c for c in kept if not c.startswith("_")]
    return tried.groupBy(*plain).agg(
        (F.first("_low") + F.count_if(F.col("_k").isNotNull() & (F.col("_nth") <= F.col("_open")))).alias("won"))


def quotas(targets: DataFrame, shards: int = SHARDS, resolution: int = RESOLUTION) -> DataFrame:
    """Per shard and source: ``quota`` blocks of ``block`` words.  Sources at
    their cap are given whole and take no part."""
    rows = targets.where("not capped")
    n, left = rows.agg(F.count("*"), F.sum("target")).first()
    left = int(round(left or 0))
    block = max(1, left // max(1, n * resolution))
    blocks = left // block
    steps = rows.select(*KEY, "target", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("shard"))
    steps = steps.withColumn("seats", F.floor(F.col("shard") * F.lit(blocks).cast("long") / shards))
    won = apportion(steps, ["shard"], "target", "seats", [F.col("known").desc(), "name"])
    before = F.lag("won", 1, 0).over(Window.partitionBy(*KEY).orderBy("shard"))
    return won.select(*KEY, "shard", (F.col("won") - before).alias("quota"), F.lit(block).cast("long").alias("block"))


def placed(spark: SparkSession, docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP,
           shards: int = SHARDS, resolution: int = RESOLUTION, seed: int = SEED) -> DataFrame:
    """Every document with its interval in its source's stream and the
    source's numbers: ``blocks`` of ``block`` words, taken ``passes`` times
    all and then the first ``rest`` of the seeded order once more."""
    sizes = saved(sized(docs, seed), "sizes")
    bins = max(1, -(-sizes.count() // BIN_DOCS))
    sizes = sizes.withColumn("bin", F.pmod(F.xxhash64("place"), F.lit(bins)))
    targets = source_targets(sizes, weights, cap)
    upto = F.sum("quota").over(Window.partitionBy(*KEY).orderBy("shard"))
    won = quotas(targets, shards, resolution).withColumn("upto", upto).groupBy(*KEY).agg(
        F.sum("quota").alias("quota"), F.first("block").alias("block"),
        F.sort_array(F.collect_list(F.struct("shard", "upto"))).alias("ends"))   # one entry a shard of the mix
    plan = targets.join(won, KEY, "left")
    block = F.coalesce("block", F.greatest("source_size", F.lit(1).cast("long")))
    blocks = F.greatest(F.ceil(F.col("source_size") / block), F.lit(1))
    quota = F.when(F.col("capped"), cap * blocks).otherwise(F.least(cap * blocks, F.coalesce("quota", F.lit(0))))
    plan = plan.select(*KEY, "source_size", "target", block.alias("block"), blocks.alias("blocks"), quota.alias("quota"), "ends")
    plan = plan.select("*", F.expr("quota div blocks").alias("passes"), (F.col("quota") % F.col("blocks")).alias("rest"),
                       F.pmod(F.xxhash64(F.lit(seed), *KEY), "blocks").alias("shift"))
    stream = Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = (sizes.groupBy(*KEY, "bin").agg(F.sum("size").alias("words"))
             .withColumn("base", F.coalesce(F.sum("words").over(stream), F.lit(0).cast("long")))
             .drop("words").join(plan, KEY))
    ahead = (Window.partitionBy(*KEY, "bin").orderBy("place", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (sizes.withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0).cast("long")))
            .join(bases, [*KEY, "bin"]).withColumn("start", F.col("base") + F.col("ahead")).drop("base", "ahead"))


def _touched() -> Column:
    """The blocks that a document's interval meets: number, place in the
    seeded order, and how many of its words lie in the block."""
    first, end = F.col("start"), F.col("start") + F.col("size")
    numbers = F.when(F.col("size") > 0, F.sequence(F.expr("start div block"), F.expr("(start + size - 1) div block")))
    step = F.lit(PRIME) % F.col("blocks")
    return F.transform(numbers, lambda b: F.struct(
        b.alias("number"),
        ((step * b + F.col("shift")) % F.col("blocks")).alias("nth"),
        F.greatest(b * F.col("block"), first).alias("from"),
        (F.least((b + 1) * F.col("block"), end) - F.greatest(b * F.col("block"), first)).alias("words")))


def mix(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target (of its
    source) and taken (words that the mix takes of it, repeats counted).

    Nulls: a null text has size 0, null sources are one source, ordered last;
    a null doc_id is a row like any other.  Empty texts have size 0 and give
    nothing.  Very long texts are counted whole; a text of many blocks is
    partly taken.  Ties: equal quotients go to the source first in order;
    equal seeded places are ordered by doc_id and size, so rows that
    differ in neither are interchangeable.  Repeated rows each count.  An
    empty table gives an empty result; where all texts are empty, targets
    are 0.  Other columns of ``docs``, whatever their names, are not read.
    """
    part = F.aggregate(
        F.coalesce(F.filter(_touched(), lambda t: t["nth"] < F.col("rest")), F.expr("array()")),
        F.lit(0).cast("long"), lambda a, t: a + t["words"])
    return placed(spark, docs, **options).select(
        "doc_id", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.when(F.col("rest") > 0, part).otherwise(0)).cast("long").alias("taken"),
        F.when(F.col("known"), F.col("name")).alias("source"))


def pieces(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: doc_id, source, ``first_word`` (from 0) and ``words``
    of each stretch taken, ``pass`` (from 0) and ``shard`` (from 1; null for a
    source at its cap, which is in every mix whole, ``CAP`` times)."""
    rows = placed(spark, docs, **options).withColumn("t", F.explode(_touched()))
    times = F.col("passes") + (F.col("t.nth") < F.col("rest")).cast("long")
    rows = rows.withColumn("pass", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))))
    turn = F.col("pass") * F.col("blocks") + F.col("t.nth")
    return rows.select(
        "doc_id", F.when(F.col("known"), F.col("name")).alias("source"),
        (F.col("t.from") - F.col("start")).alias("first_word"), F.col("t.words").alias("words"), "pass",
        F.get(F.filter("ends", lambda e: e["upto"] > turn), F.lit(0))["shard"].alias("shard"))
