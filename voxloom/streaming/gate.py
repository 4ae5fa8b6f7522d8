"""The transcript gate as a stream: new files of transcripts are cleaned and judged as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from voxloom.operators import gate
from voxloom.settings import Cleaning, Gate


def decisions(stream: DataFrame, clean: Cleaning = Cleaning(), cfg: Gate = Gate(), late: str = "3 days") -> DataFrame:
    """Decisions of a stream of raw transcripts; copies that arrive within ``late`` of each other count once."""
    stream = stream.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))  # a watermark wants a zone
    once = stream.withWatermark("ingested_at", late).dropDuplicatesWithinWatermark(["id", "text"])
    return gate.decisions(gate.cleaned(once, clean), cfg, extra=("source_folder", "ingested_at"))


def hourly(decided: DataFrame, late: str = "3 days") -> DataFrame:
    """Accepted and rejected per source and hour of arrival."""
    return decided.withWatermark("ingested_at", late).groupBy(F.window("ingested_at", "1 hour").alias("w"), "source_folder").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")).select(F.col("w.start").alias("hour"), "source_folder", "accepted", "rejected")


def run(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Judges all that lies in ``folder`` and ends; a later call goes on where this one stopped."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return decisions(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("accepted").trigger(availableNow=True).start()
