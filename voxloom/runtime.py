"""Session helpers shared by all operators: table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset and
    the master is local a temporary folder is chosen, and removed at the end.
    Without either, tables written by one machine would be lost to the others:
    that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("voxloom.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="voxloom-")
        atexit.register(shutil.rmtree, folder, True)
        found = "file://" + folder
        spark.conf.set("voxloom.shared.dir", found)
    return found


_WRITTEN: dict[str, list[str]] = {}


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers share one evaluation. :func:`release` deletes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that :func:`durable` wrote for this application; to be called when their results have been read."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
