"""Datasets of accepted clips: transcript joins, resuming, export lines, summaries and unions of datasets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voxloom.functions import text as T
from voxloom.runtime import durable


def transcripts(manifest: DataFrame, segments: DataFrame, language: str = "vi") -> DataFrame:
    """Clips with the text of their segment, joined on ``id``; a clip without a segment is an error.

    Of several segments of one id the last in order of (start, end) counts.
    """
    keep = ["text", "language", "avg_logprob", "speaker_id", "start", "end"]
    have = [c for c in keep if c in segments.columns]
    s = segments.groupBy("id").agg(F.max_by(F.struct(*have), F.struct("start", "end")).alias("s")).withColumnRenamed("id", "_id")
    m = manifest.join(s, F.col("id") == F.col("_id"), "left")
    got = lambda c, kind: F.col(f"s.{c}") if c in have else F.lit(None).cast(kind)
    checked = F.when(F.col("_id").isNull(), F.raise_error(F.concat(F.lit("the manifest names an unknown segment: "), F.coalesce("id", F.lit("null")))).cast("string")).otherwise(got("text", "string"))
    time = lambda c: F.coalesce(F.col(c), got(c, "double")) if c in manifest.columns else got(c, "double")
    return m.select("id", "audio_path", checked.alias("text"), F.coalesce(got("language", "string"), F.lit(language)).alias("language"), "duration", got("avg_logprob", "double").alias("avg_logprob"), F.lit(None).cast("double").alias("no_speech_prob"), got("speaker_id", "string").alias("speaker_id"), time("start").alias("start"), time("end").alias("end"), F.lit(None).cast("string").alias("error"))


def path_key(path: Column) -> Column:
    """A path in one spelling: forward slashes, no '.', '//' or trailing slash."""
    p = F.translate(path, "\\", "/")
    p = F.regexp_replace(F.regexp_replace(p, "/(?:\\./)+", "/"), "/{2,}", "/")
    return F.regexp_replace(F.regexp_replace(p, "^(?:\\./)+(?=.)", ""), "(?<=.)/\\.?$", "")


def completed(previous: DataFrame) -> DataFrame:
    """Earlier transcripts that can be used again: no error, and an id or a path."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return previous.where(blank("error") & (~blank("id") | ~blank("audio_path")))


def resume(manifest: DataFrame, previous: DataFrame, order: str = "line_no") -> DataFrame:
    """The manifest with what earlier runs transcribed: ``reused`` and text, language, avg_logprob, no_speech_prob.

    A clip finds its transcript by path; by id only if that transcript has no
    path. Of several the last in ``order`` counts.
    """
    p = completed(previous)
    vals = F.struct("text", "language", "avg_logprob", "no_speech_prob")
    has_path = F.coalesce(F.col("audio_path"), F.lit("")) != ""
    by_path = p.where(has_path).groupBy(path_key(F.col("audio_path")).alias("_p")).agg(F.max_by(vals, order).alias("v1"))
    # the last transcript of an id decides, and only counts if it has no path
    by_id = p.where(F.coalesce("id", F.lit("")) != "").groupBy(F.col("id").alias("_i")).agg(F.max_by(F.struct(vals.alias("v"), has_path.alias("p")), order).alias("l")).where("NOT l.p").select("_i", F.col("l.v").alias("v2"))
    m = manifest.withColumn("_k", path_key(F.col("audio_path")))
    m = m.join(by_path, F.col("_k") == F.col("_p"), "left").join(by_id, F.col("id") == F.col("_i"), "left")
    v = F.coalesce("v1", "v2")
    return m.withColumn("_v", v).select(*manifest.columns, F.col("_v").isNotNull().alias("reused"), *[F.col(f"_v.{c}").alias(c) for c in ("text", "language", "avg_logprob", "no_speech_prob")])


def check_accepted(accepted: DataFrame) -> DataFrame:
    """The rows unchanged; an error for a row that is not accepted, has no text or no duration above 0."""
    bad = ~F.coalesce("accepted", F.lit(True)) | ~F.coalesce(F.col("duration") > 0, F.lit(False)) | (T.strip(F.coalesce("cleaned_text", F.lit(""))) == "")
    return accepted.withColumn("id", F.when(bad, F.raise_error(F.concat(F.lit("not an accepted record: "), F.coalesce("id", F.lit("null")))).cast("string")).otherwise(F.col("id")))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def metadata_lines(accepted: DataFrame) -> DataFrame:
    """(line): ``file|text``."""
    return accepted.select(F.concat_ws("|", base_name(F.col("audio_path")), T.metadata_text(F.col("cleaned_text"))).alias("line"))


def relative_path(path: Column, base: str) -> Column:
    b = base.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(b)), F.substring(path, len(b) + 1, 1 << 30)).otherwise(path)


def manifest_lines(accepted: DataFrame, base: str = "") -> DataFrame:
    """(line): one JSON object per clip, keys id, audio_filepath, text, duration; nulls are kept."""
    path = relative_path(F.col("audio_path"), base) if base else F.col("audio_path")
    s = F.struct("id", path.alias("audio_filepath"), F.col("cleaned_text").alias("text"), "duration")
    return accepted.select(F.to_json(s, {"ignoreNullFields": "false"}).alias("line"))


def summary(accepted: DataFrame) -> DataFrame:
    """One row: clips, total, mean, least and greatest duration; zeros for an empty dataset. Exact in milliseconds."""
    ms = F.sum(F.round(F.col("duration") * 1000).cast("bigint"))
    total = F.coalesce(ms, F.lit(0)) / 1000
    n = F.count(F.lit(1))
    zero = lambda c: F.coalesce(F.round(c, 3), F.lit(0.0))
    return accepted.agg(n.alias("total_accepted"), F.round(total, 3).alias("total_duration_seconds"), F.round(total / 3600, 4).alias("total_duration_hours"), zero(total / F.nullif(n, F.lit(0))).alias("average_duration_seconds"), zero(F.min("duration")).alias("min_duration_seconds"), zero(F.max("duration")).alias("max_duration_seconds"))


def _names(batches: Iterator[pa.RecordBatch], n_keys: int, at: int) -> Iterator[pa.RecordBatch]:
    """Appends the unique name of the name in column ``at``; groups (the first ``n_keys`` columns) follow one another, in order.

    Held are the different names of one group, not its rows: a suffixed name is
    in use if its stem has gone past its number.
    """
    now, own, following = None, set(), {}

    def used(x: str) -> bool:
        stem, _, no = x.rpartition("_")
        return x in own or (stem in following and no.isdecimal() and not no.startswith("0") and 2 <= int(no) < following[stem])

    for b in batches:
        out = []
        for *key, name in zip(*(b.column(i).to_pylist() for i in (*range(n_keys), at))):
            if now != key:
                now, own, following = key, set(), {}
            x = name
            if used(x):
                i = following.get(name, 2)
                while used(x := f"{name}_{i}"):
                    i += 1
                following[name] = i + 1
            else:
                own.add(x)
            out.append(x)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "_unique"])


def unique_names(df: DataFrame, name: str, order: list[str], out: str, within: list[str] | None = None) -> DataFrame:
    """Adds ``out``: ``name``, or the first of ``name_2``, ``name_3``, ... that no earlier row has, in the order given.

    Only names that occur twice have followers, and only names that such a
    follower may be (a name and its numbered forms: a, a_2, a_2_2) depend on one
    another. All other rows keep their names; those groups are read as sorted
    streams. A null name is a name of its own without followers.
    """
    w = within or []
    d = durable(df.withColumn("_n", F.col(name)), "names")
    double = d.where("_n IS NOT NULL").groupBy(*w, "_n").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    # the stems of each different name, shortest first, that occur twice
    names = d.where("_n IS NOT NULL").select(*w, "_n").distinct()
    parts = F.split("_n", "_")
    stems = F.filter(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "_")), lambda x: F.regexp_replace(F.substring(F.col("_n"), F.length(x) + 1, F.length("_n")), r"^(?:_(?:[2-9]|[1-9]\d+))*$", "") == "")
    same = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in w], F.lit(True))
    chains = names.select(*w, "_n", F.explode(stems).alias("_stem"))
    double = double.withColumnRenamed("_n", "_d")
    heads = chains.join(double, same(chains, double) & (chains._stem == double._d)).groupBy(*[chains[k] for k in w], "_n").agg(F.min_by("_stem", F.length("_stem")).alias("_head"))
    heads = heads.select(*[F.col(k).alias(f"_w_{k}") for k in w], F.col("_n").alias("_h"), "_head")
    on = reduce(lambda x, y: x & y, [d[k].eqNullSafe(heads[f"_w_{k}"]) for k in w], d._n == heads._h)
    d = durable(d.join(heads, on, "left").drop("_h", *[f"_w_{k}" for k in w]), "names")
    alone = d.where("_head IS NULL").withColumn("_unique", F.col("_n"))
    group = [*w, "_head"]
    rest = d.where("_head IS NOT NULL").select(*group, *[c for c in d.columns if c not in group])
    rest = rest.repartition(*group).sortWithinPartitions(*group, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields) + ", _unique string"
    named = rest.mapInArrow(lambda b, n=len(group), at=rest.columns.index("_n"): _names(b, n, at), schema)
    return alone.unionByName(named).drop("_n", "_head").withColumnRenamed("_unique", out)


def consolidate(sources: DataFrame, label: str = "source_folder") -> DataFrame:
    """Accepted records of several folders as one dataset: ids and file names carry their source's label and are unique.

    Keeps all columns of the records and adds source_id and source_audio_path.
    """
    ident = F.concat_ws("_", T.safe_token(F.col(label), "source"), T.safe_token(F.col("id")))
    name = F.regexp_extract("audio_path", r"([^/\\]*?)(\.[^./\\]*)?$", 1)
    ext = F.regexp_extract("audio_path", r"(\.[^./\\]*)$", 1)
    d = sources.withColumns({"source_id": F.col("id"), "source_audio_path": F.col("audio_path"), "_want": ident, "_file": F.concat_ws("_", T.safe_token(F.col(label), "source"), name), "_ext": ext})
    d = unique_names(d, "_want", [label, "id", "audio_path"], "_id")
    d = unique_names(d, "_file", [label, "id", "audio_path"], "_name", ["_ext"])
    return d.withColumns({"id": F.col("_id"), "audio_path": F.concat(F.lit("wavs/"), F.col("_name"), F.col("_ext"))}).drop("_want", "_file", "_ext", "_id", "_name")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, by column name; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def consolidation_report(d: DataFrame, label: str = "source_folder") -> DataFrame:
    """(source_folder, row_count, duration_seconds), and the total with source_folder null."""
    return d.rollup(label).agg(F.count(F.lit(1)).alias("row_count"), (F.coalesce(F.sum(F.round(F.col("duration") * 1000).cast("bigint")), F.lit(0)) / 1000).alias("duration_seconds"))


def parse_metadata(lines: DataFrame, line: str = "line", keep: list[str] | None = None) -> DataFrame:
    """(keep..., name, text) of ``file|text`` lines, split at the first bar; text is kept as it is.

    A line without a bar, a name that is empty or holds a path, or an empty text is an error.
    """
    p = F.split(F.col(line), "\\|", 2)
    name, text = T.strip(F.get(p, 0)), F.get(p, 1)
    bad = (F.size(p) < 2) | (name == "") | name.rlike(r"[/\\]") | (T.strip(text) == "")
    checked = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("not a metadata line: "), F.coalesce(line, F.lit("null")))).cast("string")).otherwise(name)
    return lines.select(*(keep or []), checked.alias("name"), text.alias("text"))


def merge_metadata(lines: DataFrame) -> DataFrame:
    """Metadata lines of several sources as one: adds source_name (as written), name (unique, the source in front) and text.

    ``lines``: source, source_no, line_no, line. Rows take their names in order
    of source_no and line_no; a suffix stands before the extension.
    """
    p = parse_metadata(lines, keep=lines.columns).withColumnRenamed("name", "source_name")
    prefix = F.regexp_replace(F.regexp_replace("source", r"[^\p{L}\p{N}._\-]+", "_"), r"^[._\-]+|[._\-]+$", "")
    p = p.withColumns({"_stem": F.concat_ws("_", prefix, F.regexp_replace("source_name", r"(?<=.)\.[^.]*$", "")), "_ext": F.regexp_extract("source_name", r"(?<=.)(\.[^.]*)$", 1)})
    u = unique_names(p, "_stem", ["source_no", "line_no"], "_name", ["_ext"])
    return u.withColumn("name", F.concat("_name", "_ext")).drop("_stem", "_ext", "_name")


def missing_transcripts(manifest: DataFrame, previous: DataFrame, order: str = "line_no") -> DataFrame:
    """(missing): how many clips no earlier run transcribed."""
    return resume(manifest, previous, order).agg(F.count_if(~F.col("reused")).alias("missing"))


def mean_or_null(value: Column) -> Column:
    """The mean of the values there are, four decimals; null if there are none."""
    return F.round(F.avg(T.finite(value)), 4)


def missing_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The rows whose ``name`` is no file of the listing."""
    return rows.join(files.select(F.col("name").alias("_n")).distinct(), F.col("name") == F.col("_n"), "left_anti")
