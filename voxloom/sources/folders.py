"""Datasets as folders on a file system that all machines share: checks, merging numbered folders, copying clips, complete outputs.

A folder holds ``metadata.csv`` (file|text) and ``wavs/``, and from a run of this
package ``accepted.jsonl``, ``manifest.jsonl`` and ``summary.json`` as well.
Listings and file copies run on the executors; the driver sees counts only.
"""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxloom.functions import text as T
from voxloom.operators import dataset

#: What a complete output consists of.
COMPLETE = ("summary.json", "metadata.csv", "manifest.jsonl", "accepted.jsonl")


@dataclass(frozen=True)
class Merged:
    source_count: int
    row_count: int
    wav_count: int


def inside(path: str, folder: str) -> bool:
    """Whether ``path`` is ``folder`` or lies in it, links resolved."""
    a, b = os.path.realpath(path), os.path.realpath(folder)
    return a == b or os.path.commonpath([a, b]) == b


def check_sources(sources: list[str], needed: tuple[str, ...]) -> None:
    """An error for no source, one given twice, one that is no folder, or one that lacks a needed entry."""
    if not sources:
        raise ValueError("no source folder is given")
    seen: set[str] = set()
    for s in sources:
        if (real := os.path.realpath(s)) in seen:
            raise ValueError(f"source given twice: {s}")
        seen.add(real)
        if not os.path.isdir(s):
            raise ValueError(f"not a folder: {s}")
        for n in needed:
            if not os.path.exists(os.path.join(s, n)):
                raise ValueError(f"source {s} has no {n}")


def prepare_target(target: str, sources: list[str], force: bool = False) -> None:
    """Makes an empty target; an error if it is a source or lies in one, or exists without ``force``."""
    for s in sources:
        if inside(target, s) or (force and inside(s, target)):
            raise ValueError(f"the target {target} and the source {s} must not lie in one another")
    if os.path.lexists(target):
        if not force:
            raise FileExistsError(target)
        shutil.rmtree(target) if os.path.isdir(target) and not os.path.islink(target) else os.unlink(target)
    os.makedirs(os.path.join(target, "wavs"))


def copy_files(pairs: DataFrame) -> DataFrame:
    """(source, target, error): copies ``source`` to ``target`` for each row; a failed copy has its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            errors = []
            for a, z in zip(b["source"], b["target"]):
                try:
                    shutil.copyfile(a, z)
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield b.assign(error=errors)

    return pairs.select("source", "target").mapInPandas(run, "source string, target string, error string")


def files_in(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(folder, name) of the regular files directly in each folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in b["folder"]:
                with os.scandir(f) as entries:
                    yield pd.DataFrame([(f, e.name) for e in entries if e.is_file()], columns=["folder", "name"])

    return spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders)).mapInPandas(run, "folder string, name string")


def resolve_audio(rows: DataFrame, exists: Callable[[str], bool] = os.path.isfile) -> DataFrame:
    """Adds ``found``: the first of audio_path, source_dir/audio_path and source_dir/wavs/name that is a file; none is an error."""

    @F.pandas_udf("string")
    def first(path: pd.Series, source: pd.Series) -> pd.Series:
        def one(p: str, s: str) -> str:
            tries = [p] if os.path.isabs(p) else [p, os.path.join(s, p), os.path.join(s, "wavs", os.path.basename(p))]
            for t in tries:
                if exists(t):
                    return t
            raise FileNotFoundError(f"no audio file for source {s}: {p}")

        return pd.Series([one(p, s) for p, s in zip(path, source)])

    return rows.withColumn("found", first("audio_path", "source_dir"))


def merge_numbered(spark: SparkSession, root: str, start: int, end: int, target: str, force: bool = False, pattern: str = "mc{}_stt") -> Merged:
    """Merges the folders of numbers ``start`` to ``end`` into one; text is kept as it is, every row needs its WAV.

    Names get their folder's name in front and are made unique in order of
    folder and line. A metadata file is read as one record, so it must be
    smaller than 2 GB.
    """
    if start < 1 or end < start:
        raise ValueError(f"not a range of folders: {start} to {end}")
    if not os.path.isdir(root):
        raise ValueError(f"not a folder: {root}")
    sources = [os.path.join(root, pattern.format(i)) for i in range(start, end + 1)]
    check_sources(sources, ("metadata.csv", "wavs"))
    prepare_target(target, sources, force)
    texts = spark.read.text([os.path.join(s, "metadata.csv") for s in sources], wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    order = spark.createDataFrame([(i, os.path.basename(s), s) for i, s in enumerate(sources)], "source_no int, source string, folder string")
    lines = texts.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("source"), F.posexplode(F.split(F.regexp_replace("value", "^\\x{feff}", ""), "\r?\n")).alias("line_no", "line")).join(order, "source")
    rows = dataset.merge_metadata(lines.where(T.strip(F.col("line")) != ""))
    rows = rows.withColumn("wav", F.concat_ws("/", "folder", F.lit("wavs"), "source_name")).persist()
    try:
        have = files_in(spark, [f"{s}/wavs" for s in sources]).select(F.concat_ws("/", "folder", "name").alias("wav"))
        lost = rows.join(have, "wav", "left_anti").select("wav").limit(5).collect()
        if lost:
            raise FileNotFoundError("metadata names missing files: " + ", ".join(r.wav for r in lost))
        failed = copy_files(rows.select(F.col("wav").alias("source"), F.concat(F.lit(f"{target}/wavs/"), "name").alias("target"))).where("error IS NOT NULL").limit(5).collect()
        if failed:
            raise OSError("; ".join(r.error for r in failed))
        n = rows.count()
        if not n:
            raise ValueError("no metadata rows were merged")
        part = os.path.join(target, "metadata.parts")
        out = rows.select(F.concat_ws("|", "name", "text").alias("value"), "source_no", "line_no").orderBy("source_no", "line_no")
        out.select("value").write.text("file://" + os.path.realpath(part))
        # the parts in order, as one file
        with open(os.path.join(target, "metadata.csv"), "wb") as f:
            for p in sorted(x for x in os.listdir(part) if x.startswith("part-")):
                with open(os.path.join(part, p), "rb") as g:
                    shutil.copyfileobj(g, f)
        shutil.rmtree(part)
    finally:
        rows.unpersist()
    wavs = files_in(spark, [f"{target}/wavs"]).count()
    if wavs != n:
        raise ValueError(f"{wavs} files for {n} rows")
    return Merged(len(sources), n, wavs)


def complete_summary(folder: str) -> dict | None:
    """The summary of a complete output (all of COMPLETE, totals that are numbers), else None."""
    # a table written by several tasks is a folder
    if not all(os.path.exists(os.path.join(folder, n)) for n in COMPLETE):
        return None
    try:
        with open(os.path.join(folder, "summary.json"), encoding="utf-8") as f:
            s = json.load(f)
        float(s["total_duration_seconds"]), int(s["total_accepted"])
    except (OSError, ValueError, TypeError, KeyError):
        return None
    return s if isinstance(s, dict) else None


def output_name(path: Column) -> Column:
    """The name of a recording's output folder."""
    return F.concat(T.safe_stem(path), F.lit("_stt"))
