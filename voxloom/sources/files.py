"""Files: listings, JSON lines, WAV clips, and the writers of a dataset."""

from __future__ import annotations

import io
import json
import math
import os
import wave
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as Ty

from voxloom.functions import text as T

CLIPS = 64  # clips of a file that are sent on together
AUDIO = ("mp3", "wav", "m4a", "flac")


def audio_listing(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """(path, length[, content]) of audio files below ``folder``, any case of suffix, in order of path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    cols = ["path", "length", *(["content"] if content else [])]
    return files.where(F.lower("path").rlike(r"\.(" + "|".join(AUDIO) + ")$")).select(*cols).orderBy("path")


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | Ty.StructType, strict: bool = True) -> DataFrame:
    """JSON lines under a fixed schema; a byte-order mark and blank lines are skipped; with ``strict`` a bad line is an error that shows it."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\x{feff}", "").alias("value")).where(F.trim("value") != "")
    s = Ty.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = Ty.StructType([*s.fields, Ty.StructField("_bad", Ty.StringType())])
    parsed = lines.select("value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    # an error must not be lost to column pruning: it sits in the row's struct itself
    row = F.when(F.col("r._bad").isNotNull() | F.col("r").isNull(), F.raise_error(F.concat(F.lit("not a JSON record: "), F.substring("value", 1, 200)))).otherwise(F.col("r")) if strict else F.col("r")
    return parsed.select(row.alias("r")).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in s.fields])


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document: one object or a list of objects."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> int:
    """Writes JSON lines with nulls kept; returns the rows written, counted again from the files."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
    return df.sparkSession.read.text(path).count()


def write_lines(lines: DataFrame, path: str) -> int:
    lines.select(F.col("line").alias("value")).write.mode("overwrite").text(path)
    return lines.sparkSession.read.text(path).count()


def write_report(df: DataFrame, path: str) -> dict[str, Any]:
    """A report of one row as an indented JSON document."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report has one row")
    doc = json_safe(rows[0].asDict(True))
    # written through the file system of the path, wherever that is
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path))
    out = where.getFileSystem(conf).create(where, True)
    out.write((json.dumps(doc, ensure_ascii=False, indent=2) + "\n").encode())
    out.close()
    return doc


def json_safe(x: Any) -> Any:
    """Values as JSON can hold them: NaN and infinities become null, unknown objects text."""
    if isinstance(x, float):
        return x if math.isfinite(x) else None
    if isinstance(x, dict):
        return {str(k): json_safe(v) for k, v in x.items()}
    if isinstance(x, list | tuple | set):
        return [json_safe(v) for v in x]
    if isinstance(x, str):
        return x.encode("utf-8", "replace").decode()
    return x if x is None or isinstance(x, bool | int) else str(x)


# --- WAV --------------------------------------------------------------------------------------------------------


@F.pandas_udf(Ty.StructType([Ty.StructField("rate", Ty.IntegerType()), Ty.StructField("channels", Ty.IntegerType()), Ty.StructField("bits", Ty.IntegerType()), Ty.StructField("frames", Ty.LongType()), Ty.StructField("duration", Ty.DoubleType()), Ty.StructField("error", Ty.StringType())]))
def wav_header(content: pd.Series) -> pd.DataFrame:
    """What a WAV file says of itself; nulls and ``error`` if it is none."""
    out = []
    for c in content:
        try:
            with wave.open(io.BytesIO(c)) as w:
                out.append((w.getframerate(), w.getnchannels(), 8 * w.getsampwidth(), w.getnframes(), round(w.getnframes() / w.getframerate(), 3), None))
        except Exception as e:  # noqa: BLE001
            out.append((None, None, None, None, None, str(e) or "no WAV"))
    return pd.DataFrame(out, columns=["rate", "channels", "bits", "frames", "duration", "error"]).astype({"rate": "Int32", "channels": "Int32", "bits": "Int32", "frames": "Int64"})


@F.pandas_udf(Ty.ArrayType(Ty.FloatType()))
def wav_samples(content: pd.Series) -> pd.Series:
    """Mono samples in [-1, 1) of a 16-bit WAV: channels are averaged; null if it is none."""

    def one(c: bytes | None) -> np.ndarray | None:
        try:
            with wave.open(io.BytesIO(c)) as w:
                if w.getsampwidth() != 2:
                    return None
                x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
                return x.reshape(-1, w.getnchannels()).mean(1)
        except Exception:  # noqa: BLE001
            return None

    return content.map(one)


def check_wav(df: DataFrame, rate: int, header: str = "header") -> DataFrame:
    """The rows unchanged; an error for one that is not 16-bit mono at ``rate``."""
    ok = (F.col(f"{header}.bits") == 16) & (F.col(f"{header}.channels") == 1) & (F.col(f"{header}.rate") == rate)
    return df.withColumn(header, F.when(~F.coalesce(ok, F.lit(False)), F.raise_error(F.lit(f"not a 16-bit mono WAV at {rate} Hz")).cast(df.schema[header].dataType)).otherwise(F.col(header)))


def cut_wavs(files: DataFrame, segments: DataFrame) -> DataFrame:
    """(file_id, id, content, duration, flag): the clip of each segment, cut from its file's WAV.

    ``files`` (file_id, content), ``segments`` (file_id, id, start, end). Frames
    are round-half-even(seconds x rate). A segment that reaches beyond the file
    is cut at its end and flagged 'clamped'; one wholly outside, or whose file
    cannot be read, has null content and flag 'outside' or 'unreadable'.
    """

    # the few numbers of a file's segments travel to the file, once
    parts = segments.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "id"))).alias("parts"))

    def clips(c: bytes | None, parts: list) -> Iterator[tuple]:
        try:
            with wave.open(io.BytesIO(c)) as w:
                r, n = w.getframerate(), w.getnframes()
                for s, e, i in parts:
                    a, z = round(s * r), round(e * r)
                    flag, z = "clamped" if z > n else None, min(z, n)
                    if a >= z or a < 0:
                        yield i, None, None, "outside"
                        continue
                    w.setpos(a)
                    buf = io.BytesIO()
                    with wave.open(buf, "wb") as o:
                        o.setparams(w.getparams())
                        o.writeframes(w.readframes(z - a))
                    yield i, buf.getvalue(), round((z - a) / r, 3), flag
        except (wave.Error, EOFError, TypeError):
            yield from ((i, None, None, "unreadable") for _, _, i in parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f, c, p in zip(b["file_id"], b["content"], b["parts"]):
                out = []
                for x in clips(c, [tuple(y.values()) if isinstance(y, dict) else tuple(y) for y in p]):
                    out.append((f, *x))
                    if len(out) == CLIPS:
                        yield pd.DataFrame(out, columns=["file_id", "id", "content", "duration", "flag"])
                        out = []
                yield pd.DataFrame(out, columns=["file_id", "id", "content", "duration", "flag"])

    joined = files.select("file_id", "content").join(parts, "file_id")
    return joined.mapInPandas(run, "file_id string, id string, content binary, duration double, flag string")


def safe_id(file_id: Column) -> Column:
    """A recording's name as the beginning of its clips' names."""
    return T.safe_stem(file_id)


def check_cuts(cuts: DataFrame, expected: str = "expected", tolerance: float = 0.05) -> DataFrame:
    """The rows unchanged; an error for a clip that is missing, empty, or not as long as ``expected`` within ``tolerance`` seconds."""
    ok = (F.col("duration") > 0) & (F.abs(F.col("duration") - F.col(expected)) <= tolerance + 1e-9)
    said = F.concat(F.lit("a cut clip is not as long as its segment: "), F.coalesce("id", F.lit("null")))
    return cuts.withColumn("duration", F.when(F.coalesce(ok, F.lit(False)), F.col("duration")).otherwise(F.raise_error(said).cast("double")))


def write_routes(df: DataFrame, by: str, routes: tuple[str, ...], folder: str) -> dict[str, int]:
    """JSON lines of each value of ``by`` to ``folder/<value>.jsonl``; returns the rows of each, none may be left over."""
    from voxloom.runtime import durable

    d = durable(df, "routes")
    n = {r: write_jsonl(d.where(F.col(by) == r).drop(by), f"{folder}/{r}.jsonl") for r in routes}
    if sum(n.values()) != d.count():
        raise ValueError(f"rows of {by} beyond {routes}")
    return n
