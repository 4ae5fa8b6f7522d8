"""Segments out of voice-activity spans: greedy merge of short ones, equal split of long ones, length band, numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from voxloom.settings import Spans

MERGED = "file_id string, start double, end double, source string"
SHARD_SEC = 600.0


def valid_spans(df: DataFrame) -> DataFrame:
    """(file_id, start, end) with finite times, start >= 0 and end > start, copies once."""
    ok = F.abs("start") < float("inf")
    return df.select("file_id", "start", "end").where(ok & ~F.isnan("start") & ~F.isnan("end") & (F.abs("end") < float("inf")) & (F.col("start") >= 0) & (F.col("end") > F.col("start"))).distinct()


def bad_spans(df: DataFrame) -> DataFrame:
    """(file_id, rows, bad): per file the rows read and those that :func:`valid_spans` leaves out."""
    number = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    ok = number("start") & number("end") & F.coalesce((F.col("start") >= 0) & (F.col("end") > F.col("start")), F.lit(False))
    return df.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("bad"))


def check_spans(df: DataFrame) -> DataFrame:
    """(file_id, start, end) as they are; an error for a span that is no number, begins before 0 or does not end after its start."""
    ok = ~F.isnan("start") & ~F.isnan("end") & (F.abs("end") < float("inf")) & (F.col("start") >= 0) & (F.col("end") > F.col("start"))
    said = F.concat(F.lit("not a span: "), F.to_json(F.struct("file_id", "start", "end")))
    return df.select("file_id", F.when(F.coalesce(ok, F.lit(False)), F.col("start")).otherwise(F.raise_error(said).cast("double")).alias("start"), "end")


def _pieces(spans: DataFrame, cfg: Spans, shard_sec: float) -> DataFrame:
    """Adds ``piece``: stretches of a file between spans where the fold of :func:`merge_short` starts anew whatever came before.

    It does after a gap of more than ``merge_gap_sec`` to the span before, and
    after a span of ``min_sec`` or more. The first span of a time shard has its
    predecessor in an earlier one: that is settled on one summary row a shard.
    """
    t = spans.select("file_id", "start", "end", F.floor(F.col("start") / shard_sec).alias("_shard"))
    by = W.partitionBy("file_id", "_shard").orderBy("start", "end")
    anew = lambda b, start: F.coalesce((start - b["end"] > cfg.merge_gap_sec) | (b["end"] - b["start"] >= cfg.min_sec), F.lit(True)).cast("int")
    t = t.withColumn("_b", F.lag(F.struct("start", "end")).over(by))
    t = t.withColumn("_new", F.when(F.col("_b").isNull(), 0).otherwise(anew(F.col("_b"), F.col("start"))))
    at = F.struct("start", "end")
    per = t.groupBy("file_id", "_shard").agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.sum("_new").alias("_n"))
    order = W.partitionBy("file_id").orderBy("_shard")
    per = per.withColumn("_head", anew(F.lag("_last").over(order), F.col("_first.start")))
    per = per.withColumn("_off", F.coalesce(F.sum(F.col("_n") + F.col("_head")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("_head"))
    p = per.select(F.col("file_id").alias("_f"), F.col("_shard").alias("_s"), "_off")
    t = t.withColumn("_run", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    t = t.join(p, t.file_id.eqNullSafe(p._f) & (t._shard == p._s))
    return t.select("file_id", (F.col("_run") + F.col("_off")).alias("piece"), "start", "end")


def merge_short(spans: DataFrame, cfg: Spans = Spans(), shard_sec: float = SHARD_SEC) -> DataFrame:
    """Short spans merged greedily with their successors (see MERGED).

    A span shorter than ``min_sec`` takes the next one while the gap is at most
    ``merge_gap_sec`` and both together are at most ``max_sec``; the end is the
    later span's end. The fold runs over sorted streams and holds one span at a
    time. A file is cut where the fold starts anew, and its pieces are spread
    over the tasks like those of other files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur: list | None = None
        out: list[list] = []

        def batch() -> pa.RecordBatch:
            f, s, e, m, _ = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(s, pa.float64()), pa.array(e, pa.float64()), pa.array(["vad_merged" if x else "vad_raw" for x in m])], names=["file_id", "start", "end", "source"])

        for b in batches:
            for f, p, s, e in zip(*(b.column(i).to_pylist() for i in range(4))):
                if cur and cur[0] == f and cur[4] == p and cur[2] - cur[1] < cfg.min_sec and max(0.0, s - cur[2]) <= cfg.merge_gap_sec and e - cur[1] <= cfg.max_sec:
                    cur[2], cur[3] = e, True
                else:
                    if cur:
                        out.append(cur)
                    cur = [f, s, e, False, p]
            if len(out) > 10_000:
                yield batch()
        if cur:
            out.append(cur)
        if out:
            yield batch()

    ordered = _pieces(spans, cfg, shard_sec).repartition("file_id", "piece").sortWithinPartitions("file_id", "piece", "start", "end")
    return ordered.mapInArrow(run, MERGED)


def split_long(segments: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """Segments longer than ``max_sec`` cut into equal chunks of about ``force_split_target_sec``."""
    d = F.col("end") - F.col("start")
    chunks = F.greatest(F.lit(2), (d / cfg.force_split_target_sec + 0.999999).cast("int"), F.ceil(d / cfg.max_sec).cast("int"))
    n = F.when(d > cfg.max_sec, chunks).otherwise(1)
    s = segments.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    size = (F.col("end") - F.col("start")) / F.col("n")
    start = F.when(F.col("n") == 1, F.col("start")).otherwise(F.col("start") + size * F.col("i"))
    end = F.when(F.col("i") == F.col("n") - 1, F.col("end")).otherwise(F.col("start") + size * (F.col("i") + 1))
    return s.select("file_id", start.alias("start"), end.alias("end"), F.when(F.col("n") == 1, F.col("source")).otherwise("vad_split").alias("source"))


def numbered(rows: DataFrame, shard_sec: float = SHARD_SEC) -> DataFrame:
    """Adds ``no``: the row's number in its file in order of start and end, as six digits."""
    r = rows.withColumn("_shard", F.floor(F.col("start") / shard_sec))
    per = r.groupBy("file_id", "_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("file_id").orderBy("_shard").rowsBetween(W.unboundedPreceding, -1))
    per = per.select(F.col("file_id").alias("_f"), F.col("_shard").alias("_s"), F.coalesce(before, F.lit(0)).alias("_off"))
    r = r.join(per, r.file_id.eqNullSafe(per._f) & (r._shard == per._s))
    no = F.row_number().over(W.partitionBy("file_id", "_shard").orderBy("start", "end")) + F.col("_off")
    return r.withColumn("no", F.lpad(no.cast("string"), 6, "0")).drop("_shard", "_f", "_s", "_off")


def number(segments: DataFrame, cfg: Spans = Spans(), shard_sec: float = SHARD_SEC) -> DataFrame:
    """Segments of allowed length, numbered per file from 000001 in order of start; times to three decimals.

    A segment's number is its place in its time shard and what earlier shards hold.
    """
    d = F.col("end") - F.col("start")
    kept = segments.where((d >= cfg.min_sec) & (d <= cfg.max_sec))
    kept = numbered(kept, shard_sec)
    # decimal ties, which halves of chunks often are, go up whatever their binary form
    s, e = F.round(F.col("start") + 1e-9, 3), F.round(F.col("end") + 1e-9, 3)
    return kept.select("file_id", F.col("no").alias("id"), s.alias("start"), e.alias("end"), F.round(F.greatest(F.lit(0.0), e - s), 3).alias("duration"), "source")


def build(spans: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """Merge, split, keep the allowed lengths, number."""
    return number(split_long(merge_short(spans, cfg), cfg), cfg)


