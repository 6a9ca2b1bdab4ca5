"""Quality rules: rule features plus a hashed n-gram log-likelihood ratio.

The tokens of the n-grams are word endings (a word's last three characters,
case and trailing signs included); unigrams and bigrams of them are hashed
into ``BUCKETS`` buckets.  Two multinomials are counted, one over the texts
of the trusted target set and one over every text, both smoothed by one.  A
document's score is the sum of its n-grams' log ratios divided by their
number.  Ratios are rounded to whole millionths before they are added, so
the sum is exact in any order and the threshold decides every document the
same way on every run.

Everything is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import SPACE, SPACE_CHARS, boxed

ENDING = 3
BUCKETS = 1 << 14
MICRO = 1_000_000
# Mean log ratio (nats per n-gram) below which a text is rejected.
THRESHOLD = -0.3
MIN_WORDS = 50
# A trusted set of up to this many ids (8 bytes each) is broadcast; a larger
# one is joined by shuffle.
BROADCAST_IDS = 2_000_000


def with_words(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``words``; other input columns
    are left out unless named."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("text"), *more)
    bare = F.btrim("text", F.lit(SPACE_CHARS))
    return df.withColumn("words", F.when(bare != "", F.split(bare, f"[{SPACE}]+"))
                         .otherwise(F.array().cast("array<string>")))


def rule_features(df: DataFrame) -> DataFrame:
    """Adds the rule columns to the columns of :func:`with_words`.

    ``n_repeat_words`` counts the words inside a three-word window that
    occurs at least twice in the text: windows are sorted by (hash,
    position), equal neighbours mark the repeated ones, and the marked
    starts, sorted, cover min(3, gap to the next start) words each.
    """
    n = F.size("words")
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    df = df.withColumns({"lines": lines, "hashes": F.transform("words", lambda w: F.xxhash64(w))})
    df = df.withColumn("windows", F.transform(
        F.slice("hashes", 1, F.greatest(n - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2))))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("placed", F.when(repeated, F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: F.coalesce(x["h"] == F.get("placed", i)["h"], F.lit(False))
    df = df.withColumn("starts", F.when(F.col("placed").isNotNull(), F.sort_array(F.transform(
        F.filter("placed", lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["i"]))))
    covered = F.aggregate("starts", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s - a["last"])).alias("n"),
                                                s.alias("last")), lambda a: a["n"])
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long")}).drop(
            "lines", "hashes", "windows", "placed", "starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def endings(buckets: int) -> Column:
    """Unigram bucket of each word's ending."""
    return F.transform("words", lambda w: F.pmod(
        F.xxhash64(F.substring(w, -ENDING, ENDING)), F.lit(buckets)).cast("int"))


def pair_bucket(a: Column, b: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Per bucket, ln p(target) - ln p(raw) in millionths; the counts cover
    every text.  Neighbouring endings are counted as pairs once, and both
    n-gram sizes are derived from the pair counts.  ``buckets`` rows reach
    the driver, whatever the corpus size."""
    ids = trusted.select("doc_id").distinct().withColumn("target", F.lit(1))
    if trusted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    marked = with_words(docs.join(ids, "doc_id", "left").select("doc_id", "text", "target"), "target")
    marked = marked.select("target", endings(buckets).alias("e")).select(
        "target", F.transform("e", lambda a, i: F.struct(
            a.alias("a"), F.get("e", i + 1).alias("b"))).alias("p"))
    # outer: without the filter that an inner explode would evaluate twice
    pairs = (marked.select("target", F.explode_outer("p").alias("p")).where("p.a is not null")
             .groupBy("p.a", "p.b").agg(F.count("*").alias("raw"), F.count("target").alias("hit")))
    grams = pairs.select("raw", "hit", F.explode(F.array(
        F.col("a"), F.when(F.col("b").isNotNull(), pair_bucket(F.col("a"), F.col("b"), buckets)))).alias("g"))
    rows = (grams.where("g is not null").groupBy("g")
            .agg(F.sum("raw").alias("raw"), F.sum("hit").alias("hit")).collect())
    r, t = sum(x["raw"] for x in rows), sum(x["hit"] for x in rows)
    ratio = lambda hit, raw: round(MICRO * (math.log((hit + 1) / (t + buckets))
                                            - math.log((raw + 1) / (r + buckets))))
    out = [ratio(0, 0)] * buckets
    for x in rows:
        out[x["g"]] = ratio(x["hit"], x["raw"])
    return out


def judge(docs: DataFrame, ratios: list[int], threshold: float = THRESHOLD, *more: str) -> DataFrame:
    """Rule columns, ``n_grams``, ``score`` (mean log ratio; 0 without
    n-grams), ``base_failed`` and ``kept``; one row per row of ``docs``.
    ``more``: input columns to carry along."""
    buckets = len(ratios)
    weights = F.expr(f"cast(split('{','.join(map(str, ratios))}', ',') as array<int>)")
    both = lambda a, b: F.get(weights, a) + F.when(
        b.isNotNull(), F.get(weights, pair_bucket(a, b, buckets))).otherwise(F.lit(0))
    scored = rule_features(with_words(docs, *more)).withColumn("e", endings(buckets))
    scored = scored.withColumn("each", F.transform("e", lambda a, i: both(a, F.get("e", i + 1))))
    scored = scored.withColumns({
        "total": F.aggregate("each", F.lit(0).cast("long"), lambda a, x: a + x),
        "n_grams": F.greatest(2 * F.col("n_words") - 1, F.lit(0).cast("long"))})
    bar = int(round(threshold * MICRO))
    # always true, but not deterministic to the optimizer: without it a filter
    # on the verdict would be pushed below and repeat every expression above
    here = F.monotonically_increasing_id() >= 0
    return scored.select(
        "doc_id", *more, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams",
        F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams") / MICRO)
        .otherwise(F.lit(0.0)).alias("score"),
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("total") >= bar * F.col("n_grams")) & here).alias("kept"))


def quality_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame,
                  threshold: float = THRESHOLD, *more: str) -> DataFrame:
    """Score every row of ``docs`` against the texts that ``labels`` marks as
    good (quality 1).

    Nulls: a null text is empty (it fails the word rule); a null doc_id is
    scored like any row and is never in the trusted set.  Repeated rows are
    scored each.  Very long texts are scored whole.  Ties: a mean at the
    threshold is kept.  Columns not named in ``more`` are not read.  Without trusted texts all rows are held against an even
    target.  An empty table gives an empty result.
    """
    trusted = labels.where("quality = 1").select("doc_id")
    return judge(docs, log_ratios(docs, trusted), threshold, *more)


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    out = quality_rules(spark, boxed(docs, "doc_id", "text"), labels, THRESHOLD, "_row")
    return out.where("kept").select("_row.*")
