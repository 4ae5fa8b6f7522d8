"""Coverage of time intervals per entity: merged periods and the gaps between them.

Two-level merge. Each interval is clipped into fixed time shards, every
(entity, shard) is merged on its own, and only what reaches a shard border is
stitched across shards. One entity holding a large part of all rows is thus
spread over as many tasks as it has shards; what is gathered per entity is one
summary row (or two border pieces) for each non-empty shard.

A long interval is not copied into every shard it spans: it leaves a head and a
tail piece, and its middle travels as one block of whole shards that joins the
second level directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Width of a time shard. Only affects how work is spread, never the result.
SHARD_MS = 600_000


def to_ms(seconds: Column) -> Column:
    """Seconds as whole milliseconds; null for null, NaN, infinite or absurdly large values."""
    return F.when(F.abs(seconds) < 1e15, F.round(seconds * 1000).cast("bigint"))


def spans_ms(df: DataFrame, key: str = "file_id", start: str = "start", end: str = "end") -> DataFrame:
    """Usable spans as (entity, s, e) in whole milliseconds.

    Times are rounded first; a null or NaN time, or ``e <= s`` after rounding,
    removes the span. A null entity is an entity of its own. Other columns,
    whatever their names, are ignored.
    """
    return df.select(F.col(key).alias("entity"), to_ms(F.col(start)).alias("s"), to_ms(F.col(end)).alias("e")).where("e > s")


def _pieces(spans: DataFrame, shard_ms: int) -> DataFrame:
    """Head and tail pieces with their shard, blocks of whole shards with shard null."""
    first, last = F.floor(F.col("s") / shard_ms), F.floor((F.col("e") - 1) / shard_ms)
    spans = spans.select("entity", "s", "e", first.alias("a"), last.alias("b"))
    one = F.array(F.struct(F.col("a").alias("shard"), F.col("s").alias("s"), F.col("e").alias("e")))
    many = F.array(
        F.struct(F.col("a").alias("shard"), F.col("s").alias("s"), ((F.col("a") + 1) * shard_ms).alias("e")),
        F.struct(F.col("b").alias("shard"), (F.col("b") * shard_ms).alias("s"), F.col("e").alias("e")),
    )
    middle = F.array(F.struct(F.lit(None).cast("bigint").alias("shard"), ((F.col("a") + 1) * shard_ms).alias("s"), (F.col("b") * shard_ms).alias("e")))
    pieces = F.when(F.col("a") == F.col("b"), one).when(F.col("b") == F.col("a") + 1, many).otherwise(F.concat(many, middle))
    return spans.select("entity", F.inline(pieces))


def _levels(spans: DataFrame, shard_ms: int) -> tuple[DataFrame, DataFrame]:
    """(pieces merged to one row per entity, shard and start with the largest end; blocks, one for each shard they begin with)."""
    pieces = _pieces(spans, shard_ms)
    local = pieces.where("shard IS NOT NULL").groupBy("entity", "shard", "s").agg(F.max("e").alias("e"))
    blocks = pieces.where("shard IS NULL").groupBy("entity", "s").agg(F.max("e").alias("e"))
    return local, blocks


def _covered(local: DataFrame, blocks: DataFrame, shard_ms: int) -> DataFrame:
    """(entity, shard) that lie wholly inside a block."""
    shards = local.select("entity", "shard").distinct().select("entity", (F.col("shard") * shard_ms).alias("s"), F.lit(None).cast("bigint").alias("e"), "shard")
    # only entities that have a block at all are looked at
    shards = shards.join(blocks.select(F.col("entity").alias("_k")).distinct(), F.col("entity").eqNullSafe(F.col("_k")), "left_semi")
    both = shards.unionByName(blocks.select("entity", "s", "e", F.lit(None).cast("bigint").alias("shard")))
    reach = F.max("e").over(W.partitionBy("entity").orderBy(F.col("s"), F.col("shard").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow))
    return both.withColumn("reach", reach).where(F.col("shard").isNotNull() & (F.col("reach") >= F.col("s") + shard_ms)).select("entity", "shard")


def _anti(df: DataFrame, covered: DataFrame) -> DataFrame:
    c = covered.select(F.col("entity").alias("_k"), F.col("shard").alias("_s"))
    return df.join(c, F.col("entity").eqNullSafe(F.col("_k")) & (F.col("shard") == F.col("_s")), "left_anti")


def find_gaps(spans: DataFrame, shard_ms: int = SHARD_MS) -> DataFrame:
    """Longest stretches inside each entity that no span covers: (entity, gap_start_ms, gap_end_ms).

    ``spans`` comes from :func:`spans_ms`. Touching spans leave no gap; time
    before the first and after the last span is no gap. An entity with one span
    and an empty table give no rows. Repeated spans change nothing.
    """
    local, blocks = _levels(spans, shard_ms)
    before = W.partitionBy("entity", "shard").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    inside = local.withColumn("reach", F.max("e").over(before)).where("s > reach").select("entity", "shard", F.col("reach").alias("gap_start_ms"), F.col("s").alias("gap_end_ms"))
    inside = _anti(inside, _covered(local, blocks, shard_ms)).drop("shard")
    ends = local.groupBy("entity", "shard").agg(F.min("s").alias("s"), F.max("e").alias("e")).select("entity", "s", "e").unionByName(blocks)
    earlier = W.partitionBy("entity").orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    across = ends.withColumn("reach", F.max("e").over(earlier)).where("s > reach").select("entity", F.col("reach").alias("gap_start_ms"), F.col("s").alias("gap_end_ms"))
    return inside.unionByName(across)


def merge_periods(spans: DataFrame, shard_ms: int = SHARD_MS) -> DataFrame:
    """Continuous periods of each entity: (entity, start_ms, end_ms), touching spans joined.

    Periods that stay clear of the shard borders are final after the local
    merge; those that reach a border, and the blocks, are coalesced per entity.
    """
    local, blocks = _levels(spans, shard_ms)
    order = W.partitionBy("entity", "shard").orderBy("s")
    merged = (
        local.withColumn("reach", F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("island", F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("entity", "shard", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")
    )
    merged = _anti(merged, _covered(local, blocks, shard_ms))
    at_border = (F.col("s") == F.col("shard") * shard_ms) | (F.col("e") == (F.col("shard") + 1) * shard_ms)
    done = merged.where(~at_border).select("entity", "s", "e")
    open_ = merged.where(at_border).select("entity", "s", "e").unionByName(blocks)
    by = W.partitionBy("entity").orderBy("s", "e")
    stitched = (
        open_.withColumn("reach", F.max("e").over(by.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("island", F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(by.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("entity", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")
    )
    return done.unionByName(stitched).select("entity", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"))
