"""Mixing documents of several sources to target shares of all tokens.

Method: hash-threshold histograms. Every document has a place in [0, 2^48) by a
hash of its id. Tokens are summed by source and hash bucket, the bucket in
which a source's budget runs out is found from the running sum, only that
bucket is refined (twice more), and the mix is a filter ``place <= threshold``.
Nothing is sorted or collected by source; a source that holds a third of all
documents is 4096 sums like any other. Thresholds of smaller budgets are lower,
so smaller mixes are part of larger ones.

The mix is as large as the targets allow: the source that is scarcest against
its share, used ``max_repeats`` times, sets the total. A source whose budget
exceeds its tokens is used whole as often as it fits and the rest is drawn once
more below the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from voxloom.runtime import durable

BITS = 12  # 4096 buckets a level, three levels
_LEVELS = 3


def places(sized: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, place) of documents that can be used."""
    return sized.where("n_tokens > 0 AND source IS NOT NULL").select("doc_id", "source", "n_tokens", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - BITS * _LEVELS).alias("place"))


def budgets(placed: DataFrame, targets: DataFrame, fraction: float = 1.0) -> DataFrame:
    """One row per source that has a target and tokens: share, tokens at hand, budget, whole uses, rest to draw.

    Sources without tokens, or with a share or repeat limit that is null or not
    above 0, can contribute nothing: the shares of the others are scaled to 1.
    A source listed twice counts with its first share in binary order.
    """
    t = targets.where("target_share > 0 AND max_repeats > 0 AND source IS NOT NULL").groupBy("source").agg(F.min_by(F.struct("target_share", "max_repeats"), F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    have = placed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    b = t.join(have, "source")
    all_ = W.partitionBy(F.lit(1))  # one row per target source
    # summed as decimals: the same whatever the order of rows
    b = b.withColumn("share", F.col("target_share") / F.sum(F.col("target_share").cast("decimal(30,15)")).over(all_).cast("double"))
    b = b.withColumn("total", F.floor(F.min(F.col("tokens") * F.col("max_repeats") / F.col("share")).over(all_) * fraction))
    b = b.withColumn("budget", F.least(F.floor(F.col("total") * F.col("share") + 1e-6), F.col("tokens") * F.col("max_repeats")))
    return b.withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))


def thresholds(placed: DataFrame, budget: DataFrame) -> DataFrame:
    """(source, threshold, drawn, rest): documents with place <= threshold have ``drawn`` <= rest tokens together; null if none fits.

    Documents of the last bucket are taken in order of place as long as they
    fit; those that share a place (about 2^-48) are taken or left together.
    """
    todo = budget.select("source", "rest")
    found = None
    for level in range(_LEVELS):
        shift = BITS * (_LEVELS - 1 - level)
        last = level == _LEVELS - 1
        at = placed if found is None else placed.join(found, "source").where(F.shiftright("place", shift + BITS) == F.col("prefix"))
        hist = at.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(F.sum("n_tokens").alias("n"))
        hist = hist.join(todo, "source") if found is None else hist.join(found, "source")
        before = F.lit(0).cast("bigint") if found is None else F.col("below")
        by = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        run = hist.withColumn("upto", before + F.sum("n").over(by))
        if last:
            fits = F.when(F.col("upto") <= F.col("rest"), F.col("bucket"))
            return run.groupBy("source", "rest").agg(F.max(fits).alias("inside"), F.max(F.when(fits.isNotNull(), F.col("upto"))).alias("u"), F.min("below").alias("below"), F.min("prefix").alias("prefix")).select(
                "source", F.coalesce("inside", F.shiftleft("prefix", BITS) - 1).alias("threshold"), F.coalesce("u", "below").alias("drawn"), "rest")
        # the first bucket that does not fit whole; the last one if all do
        over = F.when(F.col("upto") > F.col("rest"), F.col("bucket"))
        found = run.groupBy("source", "rest").agg(F.coalesce(F.min(over), F.max("bucket")).alias("prefix"), F.max(F.struct("bucket", "upto")).alias("_end"), F.min(F.when(over.isNotNull(), F.struct("bucket", (F.col("upto") - F.col("n")).alias("b")))).alias("_hit"), F.max(F.struct("bucket", (F.col("upto") - F.col("n")).alias("b"))).alias("_last"))
        found = durable(found.select("source", "rest", "prefix", F.coalesce(F.col("_hit.b"), F.col("_last.b")).alias("below")), "thresholds")
    raise AssertionError


def mix(sized: DataFrame, targets: DataFrame, fraction: float = 1.0) -> DataFrame:
    """(doc_id, source, n_tokens, uses): every document of the mix and how often it is used, at least once, at most ``max_repeats`` times.

    ``fraction`` of the largest possible mix. Documents without a target source
    or without tokens take no part; no document gives no rows. Repeated
    doc_ids are documents of their own that are drawn together.
    """
    placed = durable(places(sized), "places")
    b = durable(budgets(placed, targets, fraction), "budgets")
    t = thresholds(placed, b)
    plan = b.join(t.select("source", "threshold"), "source").select("source", "whole", "threshold")
    m = placed.join(plan, "source").withColumn("uses", F.col("whole") + F.when(F.col("place") <= F.col("threshold"), 1).otherwise(0))
    return m.where("uses > 0").select("doc_id", "source", "n_tokens", "uses")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, mix_tokens, documents, max_uses) for every target; zeros for a source that gave nothing."""
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("mix_tokens"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("max_uses"))
    s = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").fillna(0, ["mix_tokens", "documents", "max_uses"])
    total = F.sum("mix_tokens").over(W.partitionBy(F.lit(1)))
    return s.withColumn("actual_share", F.round(F.when(total > 0, F.col("mix_tokens") / total).otherwise(0.0), 6))
