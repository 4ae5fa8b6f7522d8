"""The queries of this subpackage, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxloom.llm import lookalike, mixing, packing, quality, quantiles, repetition, tokens, truncation, turns
from voxloom.runtime import durable, table

METRICS = ["sample_rate", "channels", "rms_dbfs", "peak_dbfs", "clipping_ratio", "silence_ratio", "leading_silence_sec", "trailing_silence_sec", "spectral_flatness", "high_freq_energy_ratio"]


def _fixed(df: DataFrame, *cols: str, most: int = 10_000) -> list:
    """The rows of a fixed table, on the driver; an error if it is not as small as fixed tables are."""
    rows = df.select(*cols).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a fixed table has more than {most} rows")
    return rows


# 1 --------------------------------------------------------------------------------------------------------------


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    m = repetition.measure(table(spark, sf, "raw_transcripts").where("text IS NOT NULL"), "text", ["id"], with_text=False)
    # a text that loses the share to repetition alone loses it to all rules together: the rejected texts, then the exact share
    return m.where(F.col("rejected") & repetition.share_at_least(0.3)).select("id").distinct()


def p1_repetition(spark: SparkSession, sf: str) -> DataFrame:
    m = repetition.measure(table(spark, sf, "raw_transcripts"), "text", ["id", "source_folder"])
    return m.select("id", "source_folder", "rep.n_lines", "rep.n_words", "rep.repeated_words", F.round("rep.repeated_share", 6).alias("repeated_share"), "rep.lost_words", F.round("rep.lost_share", 6).alias("lost_share"), "rejected", "rep.kept_text")


# 2 --------------------------------------------------------------------------------------------------------------


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.judge(table(spark, sf, "cleaned_transcripts"), "id", "cleaned_text", "source_folder", table(spark, sf, "raw_transcripts"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf).where("cut").select("id").distinct()


def p2_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.by_source(_judged(spark, sf)).withColumnRenamed("source", "source_folder")


# 4 --------------------------------------------------------------------------------------------------------------


def _day_sketches(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("ingested_at").alias("day")
    q = table(spark, sf, "quality_metrics").select("source_folder", day, *METRICS)
    a = table(spark, sf, "accepted").select("source_folder", day, F.col("duration").alias("accepted_duration"))
    parts = quantiles.sketches(q, ["source_folder", "day"], METRICS).unionByName(quantiles.sketches(a, ["source_folder", "day"], ["accepted_duration"]))
    return quantiles.merged(parts, ["source_folder", "day"])


def p4_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Per source and day, and (day null) per source over the whole period, the latter by adding up the days' sketches."""
    days = durable(_day_sketches(spark, sf), "day-sketches")
    # the days of a month first
    months = days.select("source_folder", "metric", "n", "sketch", F.coalesce(F.trunc("day", "month"), F.lit("0001-01-01").cast("date")).alias("block"))
    whole = quantiles.merged(months, ["source_folder"]).withColumn("day", F.lit(None).cast("date"))
    return quantiles.answers(days.unionByName(whole))


def p4_without_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles over the period after copied rows have been deleted from the finished sketches again."""
    q = table(spark, sf, "quality_metrics").select("id", "source_folder", *METRICS)
    a = table(spark, sf, "accepted").select("id", "source_folder", F.col("duration").alias("accepted_duration"))
    parts = []
    for rows, metrics in ((q, METRICS), (a, ["accepted_duration"])):
        # of each row's copies all but one are taken back
        again = rows.groupBy("id", "source_folder", *metrics).agg((1 - F.count(F.lit(1))).alias("w")).where("w < 0")
        parts += [quantiles.sketches(rows, ["source_folder"], metrics), quantiles.sketches(again, ["source_folder"], metrics, weight="w")]
    return quantiles.answers(quantiles.merged(functools.reduce(DataFrame.unionByName, parts), ["source_folder"]))


def p4_rank_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Whether every percentile of the whole period is within a rank of 2 % (or one value) of the true one; exact counts."""
    ans = p4_percentiles(spark, sf).where("day IS NULL").drop("day")
    q = table(spark, sf, "quality_metrics").select("source_folder", *METRICS)
    a = table(spark, sf, "accepted").select("source_folder", F.col("duration").alias("accepted_duration"))
    values = functools.reduce(DataFrame.unionByName, [t.unpivot("source_folder", [c for c in t.columns if c != "source_folder"], "metric", "v") for t in (q.select("source_folder", *[F.col(m).cast("double").alias(m) for m in METRICS]), a)])
    values = values.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    x = values.join(ans.withColumnRenamed("n", "said"), ["source_folder", "metric"])
    names = [f"p{round(p * 100):02d}" for p in quantiles.QUANTILES]
    near = lambda c: F.abs(F.col(c)) * 2.0**-10 + 1e-30
    counts = [y for c in names for y in (F.count_if(F.col("v") < F.col(c) - near(c)).alias(f"lo_{c}"), F.count_if(F.col("v") <= F.col(c) + near(c)).alias(f"hi_{c}"))]
    g = x.groupBy("source_folder", "metric").agg(F.count(F.lit(1)).alias("n"), F.max("said").alias("said"), *counts)
    rank = {c: F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("n"))) for c, p in zip(names, quantiles.QUANTILES)}
    off = F.greatest(*[F.greatest(F.col(f"lo_{c}") + 1 - r, r - F.col(f"hi_{c}")) for c, r in rank.items()])
    return g.select("source_folder", "metric", "n", (F.col("n") == F.col("said")).alias("counted"), (off <= F.greatest(F.lit(1.0), 0.02 * F.col("n"))).alias("within"))


# 5 --------------------------------------------------------------------------------------------------------------


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "raw_transcripts").select(F.lit("raw_transcripts").alias("table_name"), "id", "text")
    clean = table(spark, sf, "cleaned_transcripts").select(F.lit("cleaned_transcripts").alias("table_name"), "id", F.col("cleaned_text").alias("text"))
    return raw.unionByName(clean)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.same_look_pairs(_texts(spark, sf), "id", "text", "table_name").withColumnRenamed("part", "table_name")


def p5_canonical(spark: SparkSession, sf: str) -> DataFrame:
    c = lookalike.canonicalise(_texts(spark, sf), "id", "text", "table_name")
    return c.select(F.col("part").alias("table_name"), "id", "canonical", (~F.col("canonical").eqNullSafe(F.col("text"))).alias("changed"), "variants")


# 6 --------------------------------------------------------------------------------------------------------------


def _fillers(spark: SparkSession, sf: str) -> list[str]:
    return [r[0] for r in _fixed(table(spark, sf, "filler_words"), "filler") if r[0]]


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    t = turns.clean_turns(table(spark, sf, "stt_words"), _fillers(spark, sf), with_text=False)
    return t.where("speaker_no IS NOT NULL").select("file_id", "speaker_no", "start_ms", "end_ms").distinct()


def p6_turns(spark: SparkSession, sf: str) -> DataFrame:
    return turns.clean_turns(table(spark, sf, "stt_words"), _fillers(spark, sf))


# 7 --------------------------------------------------------------------------------------------------------------


def _tiers(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    return [(r[0], r[1]) for r in _fixed(table(spark, sf, "pack_capacities"), "pack_name", "capacity_tokens") if r[0] is not None and r[1] and r[1] > 0]


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(tokens.sizes(table(spark, sf, "documents"), ["doc_id"]), _tiers(spark, sf))


def p7_contents(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(spark, sf)


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(_placed(spark, sf))


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.report(_placed(spark, sf))


def p7_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Of all documents with text: containers over capacity, documents whose tokens are not all placed once, in order, and those split although they fit."""
    sized = durable(tokens.sizes(table(spark, sf, "documents"), ["doc_id"]), "sizes")
    tiers = _tiers(spark, sf)
    placed = durable(packing.pack(sized, tiers), "placed")
    over = packing.containers(placed).agg(F.count_if(F.col("used_tokens") > F.col("capacity_tokens")).alias("overfull"))
    most = max(c for _, c in tiers)
    d = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("got"), F.count(F.lit(1)).alias("pieces"), F.count_distinct("piece_no").alias("numbers"), F.max("piece_no").alias("last"), F.count_if(F.col("first_token") != F.col("piece_no").cast("bigint") * most).alias("misplaced"))
    d = sized.where("n_tokens > 0").join(d, "doc_id", "left")
    whole = F.coalesce((F.col("got") == F.col("n_tokens")) & (F.col("numbers") == F.col("pieces")) & (F.col("last") + 1 == F.col("pieces")) & (F.col("misplaced") == 0), F.lit(False))
    d = d.agg(F.count(F.lit(1)).alias("documents"), F.count_if(~whole).alias("not_whole"), F.count_if(F.col("pieces") > F.ceil(F.col("n_tokens") / most)).alias("split"))
    long = lambda x: x.unpivot([], x.columns, "what", "n")
    return long(d).unionByName(long(over))


# 8 --------------------------------------------------------------------------------------------------------------


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(tokens.sizes(table(spark, sf, "documents"), ["doc_id", "source"]), table(spark, sf, "mix_targets"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf)


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(_mixed(spark, sf), table(spark, sf, "mix_targets"))


def p8_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Per target source: whether its tokens stay within its budget and miss it by less than its largest document; uses beyond the limit; documents of a half as large mix that are not in the whole one."""
    sized = durable(tokens.sizes(table(spark, sf, "documents"), ["doc_id", "source"]), "sizes")
    targets = table(spark, sf, "mix_targets")
    whole, half = (durable(mixing.mix(sized, targets, f), "mix") for f in (1.0, 0.5))
    budget = mixing.budgets(mixing.places(sized), targets).select("source", "share", "budget", "max_repeats")
    got = whole.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("got"), F.max("uses").alias("uses"))
    most = sized.groupBy("source").agg(F.max("n_tokens").alias("most"))
    lost = half.join(whole.select("doc_id", "source", F.col("uses").alias("more")), ["doc_id", "source"], "left").where("more IS NULL OR more < uses").groupBy("source").agg(F.count(F.lit(1)).alias("lost"))
    x = budget.join(got, "source", "left").join(most, "source", "left").join(lost, "source", "left").fillna(0, ["got", "uses", "lost"])
    return x.select("source", F.round("share", 9).alias("target_share"), ((F.col("got") <= F.col("budget")) & (F.col("budget") - F.col("got") < F.col("most"))).alias("within"), F.greatest(F.col("uses") - F.col("max_repeats"), F.lit(0)).cast("bigint").alias("uses_beyond"), F.col("lost").alias("not_nested"))


# 9 --------------------------------------------------------------------------------------------------------------


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    common = [r[0] for r in _fixed(table(spark, sf, "common_words"), "word") if r[0]]
    return quality.judge(table(spark, sf, "documents"), "doc_id", "text", common)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf).where("NOT is_prose").select(F.col("id").alias("doc_id")).distinct()


def p9_statistics(spark: SparkSession, sf: str) -> DataFrame:
    stats = [f"st.{c}" for c in ("n_chars", "n_lines", "n_words", "mean_word_length", "symbol_share", "digit_share", "letter_share", "terminal_line_share", "bullet_line_share", "common_share", "entry_share")]
    return _quality(spark, sf).select(F.col("id").alias("doc_id"), *stats, F.array_join("reasons", ",").alias("reasons"), "is_prose")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries; of a problem without a ``_found`` the first is the one to measure."""
    return {f.__name__: f for f in (p1_found, p1_repetition, p2_found, p2_by_source, p4_percentiles, p4_without_copies, p4_rank_errors, p5_found, p5_canonical, p6_found, p6_turns, p7_contents, p7_containers, p7_report, p7_violations, p8_mix, p8_shares, p8_violations, p9_found, p9_statistics)}


# SQL ------------------------------------------------------------------------------------------------------------


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _folded(col: str) -> str:
    """SQL for the composed plain form: composition does here what the collation does in Spark."""
    s = lookalike.single()
    a, b = _quote("".join(s)), _quote("".join(s.values()))
    inv = "".join(f"\\x{{{ord(c):X}}}" if c != "-" else "-" for c in lookalike.INVISIBLE)
    return f"trim(regexp_replace(nfc_normalize(translate(nfc_normalize(translate(regexp_replace({col}, '[{inv}]+', '', 'g'), {a}, {b})), {a}, {b})), '[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g'))"


def oracle_sql() -> dict[str, str]:
    p1 = f"""
WITH t AS (SELECT DISTINCT id, text FROM raw_transcripts WHERE text IS NOT NULL),
l AS (SELECT id, regexp_extract_all(lower({_folded('text')}), '(?:[\\p{{L}}\\p{{N}}][\\x{{300}}-\\x{{36F}}]*)+') AS ws FROM t),
w AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (SELECT id, i, CASE WHEN lead(w, 3) OVER o IS NOT NULL THEN concat_ws(' ', w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o) END AS g FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
s AS (SELECT id, i, CASE WHEN g IS NOT NULL AND row_number() OVER (PARTITION BY id, g ORDER BY i) > 1 THEN 1 ELSE 0 END AS again FROM g),
c AS (SELECT id, max(again) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS r FROM s)
SELECT id FROM c GROUP BY id HAVING sum(r) * 10 >= count(*) * 3"""
    p5 = f"""
WITH t AS (SELECT DISTINCT 'raw_transcripts' AS table_name, id, text FROM raw_transcripts WHERE text IS NOT NULL
           UNION SELECT DISTINCT 'cleaned_transcripts', id, cleaned_text FROM cleaned_transcripts WHERE cleaned_text IS NOT NULL),
f AS (SELECT *, {_folded('text')} AS look FROM t)
SELECT DISTINCT a.table_name, a.id AS id_a, b.id AS id_b FROM f a JOIN f b ON a.table_name = b.table_name AND a.look = b.look AND a.text <> b.text AND a.id < b.id"""
    finite = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS)
    p4 = f"""
WITH u AS (SELECT source_folder, metric, v FROM (UNPIVOT (SELECT source_folder, {finite} FROM quality_metrics) ON {', '.join(METRICS)} INTO NAME metric VALUE v)
           UNION ALL SELECT source_folder, 'accepted_duration', duration FROM accepted)
SELECT source_folder, metric, count(*) AS n, true AS counted, true AS within FROM u WHERE isfinite(v) GROUP BY 1, 2"""
    p7 = "SELECT what, n * (SELECT count(*) FROM documents WHERE length(text) > 0) AS n FROM (VALUES ('documents', 1), ('not_whole', 0), ('split', 0), ('overfull', 0)) v(what, n)"
    p8 = "SELECT source, round(target_share / sum(target_share) OVER (), 9) AS target_share, true AS within, 0 AS uses_beyond, 0 AS not_nested FROM mix_targets WHERE target_share > 0 AND source IN (SELECT source FROM documents WHERE length(text) > 0)"
    return {"p4_rank_errors": p4, "p7_violations": p7, "p8_violations": p8, "p1_found": p1, "p5_found": p5, "p6_found": _P6.replace("{folded}", _folded("text"))}


_P6 = r"""
WITH fw AS (SELECT string_agg(DISTINCT regexp_replace(lower(nfc_normalize(filler)), '(.)', '\1+', 'g'), '|') AS x FROM filler_words),
r AS (SELECT DISTINCT file_id, "index" AS i, start AS a, "end" AS b, lower({folded}) AS t, type, speaker_id FROM stt_words
      WHERE isfinite(start) AND isfinite("end") AND "end" > start),
k AS (SELECT *, nullif(regexp_extract(t, '^(?:>+ ?)?[\[<({]? ?(?:v )?(?:speaker|spk|s|người nói)[ _.\-]*0*(\d+) ?[\])>}]? ?[:\-–]?$', 1), '') AS lab,
      CASE WHEN coalesce(t, '') = '' THEN 'blank'
           WHEN regexp_matches(t, '^[\[(<{]?(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?[\])>}]?(?: ?-->.*)?$|^-->') THEN 'time'
           WHEN regexp_matches(t, '^(?:>+ ?)?[\[<({]? ?(?:v )?(?:speaker|spk|s|người nói)[ _.\-]*\d+ ?[\])>}]? ?[:\-–]?$') THEN 'label'
           WHEN contains(lower(coalesce(type, '')), 'event') OR regexp_matches(t, '^[\[({<*♪]|[\])}>*♪]$') THEN 'sound'
           WHEN list_bool_or([regexp_full_match(t, '[\s\-–.,!?…~:;"'']*(?:' || y || '[\s\-–.,!?…~:;"'']*)+') FOR y IN string_split((SELECT x FROM fw), '|')]) THEN 'filler'
           WHEN NOT regexp_matches(t, '[\p{L}\p{N}]') THEN 'sound'
           ELSE 'word' END AS kind FROM r),
n AS (SELECT *, CAST(coalesce(lab, nullif(regexp_extract(speaker_id, '(\d+)\D*$', 1), '')) AS INTEGER) AS named FROM k),
s AS (SELECT *, last_value(named IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY a, b, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS who FROM n),
v AS (SELECT *, CASE WHEN who = lag(who) OVER (PARTITION BY file_id ORDER BY a, b, i) THEN 0 ELSE 1 END AS new FROM s WHERE kind = 'word' AND who IS NOT NULL),
u AS (SELECT *, sum(new) OVER (PARTITION BY file_id ORDER BY a, b, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn FROM v)
SELECT DISTINCT file_id, min(who) AS speaker_no, CAST(round(arg_min(a, (a, b, i)) * 1000) AS BIGINT) AS start_ms, CAST(round(arg_max(b, (a, b, i)) * 1000) AS BIGINT) AS end_ms FROM u GROUP BY file_id, turn"""
