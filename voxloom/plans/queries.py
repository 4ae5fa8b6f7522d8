"""Queries of the core, each over its whole tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.operators import intervals
from voxloom.runtime import durable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_SPANS = """
WITH p AS (SELECT file_id, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM vad_segments
           WHERE isfinite(start) AND isfinite("end")),
r AS (SELECT file_id, s, e, max(e) OVER (PARTITION BY file_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p WHERE e > s)"""


@query(_SPANS + " SELECT DISTINCT file_id, reach AS gap_start_ms, s AS gap_end_ms FROM r WHERE s > reach")
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    gaps = intervals.find_gaps(intervals.spans_ms(table(spark, sf, "vad_segments")))
    return gaps.withColumnRenamed("entity", "file_id")


@query(_SPANS + """,
i AS (SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY file_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r)
SELECT file_id, min(s) AS start_ms, max(e) AS end_ms FROM i GROUP BY file_id, island""")
def p3_periods(spark: SparkSession, sf: str) -> DataFrame:
    periods = intervals.merge_periods(intervals.spans_ms(table(spark, sf, "vad_segments")))
    return periods.withColumnRenamed("entity", "file_id")


# --- transcripts ------------------------------------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from voxloom.functions import text as T  # noqa: E402
from voxloom.operators import dataset, gate, segmentation, signal, spans, tokens  # noqa: E402
from voxloom.settings import Cleaning, Gate, Segmentation, Signal, Spans  # noqa: E402

_SP = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _sql_clean(col: str) -> str:
    """The cleaner in SQL without look-ahead or back-references: one pass a mark, and a space after every mark."""
    t = f"nfc_normalize(regexp_replace(coalesce({col}, ''), '[\\r\\n\\t]', ' ', 'g'))"
    t = f"regexp_replace({t}, '\\p{{Cf}}+|[\\x{{1F300}}-\\x{{1FAFF}}\\x{{2600}}-\\x{{27BF}}\\x{{FE00}}-\\x{{FE0F}}]+', '', 'g')"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\\p{{M}}.,?!:;\\-''\"“”‘’`´]+', ' ', 'g')"
    for m in ".,?!:;":
        t = f"regexp_replace({t}, '[{m}]{{2,}}', '{m}', 'g')"
    t = f"regexp_replace({t}, '-{{2,}}', '-', 'g')"
    t = f"regexp_replace({t}, ' +([.,?!:;])', '\\1', 'g')"
    t = f"regexp_replace({t}, '([.,?!:;])', '\\1 ', 'g')"
    return f"trim(regexp_replace({t}, ' {{2,}}', ' ', 'g'))"


_CLEANED = f"c AS (SELECT *, {_sql_clean('text')} AS cleaned_text FROM raw_transcripts)"


@query(f"WITH {_CLEANED} SELECT id, cleaned_text, cleaned_text = '' AS is_empty_after_cleaning, cleaned_text <> coalesce(text, '') AS cleaning_changed_text FROM c")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return gate.cleaned(table(spark, sf, "raw_transcripts")).select("id", "cleaned_text", "is_empty_after_cleaning", "cleaning_changed_text")


@query(f"WITH {_CLEANED} SELECT count(*) AS total_rows, count(*) FILTER (cleaned_text <> coalesce(text, '')) AS changed_rows, count(*) FILTER (cleaned_text = '') AS empty_rows FROM c")
def clean_counts(spark: SparkSession, sf: str) -> DataFrame:
    return gate.cleaning_counts(gate.cleaned(table(spark, sf, "raw_transcripts")))


@query(f"WITH c AS (SELECT *, {_sql_clean('text')} AS cleaned_text FROM documents) SELECT doc_id, lower(cleaned_text) AS cleaned_text FROM c")
def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.clean(F.col("text"), Cleaning(lowercase_text=True)).alias("cleaned_text"))


def _sql_odd(t: str) -> str:
    return f"length(regexp_replace({t}, '[\\p{{L}}\\p{{N}}_{_SP[1:-1]}\\x{{c0}}-\\x{{1ef9}}.,?!:;\\-''“”‘’`´]+', '', 'g')) / greatest(length({t}), 1)"


@query(f"SELECT doc_id, round({_sql_odd('text')}, 9) AS unusual_symbol_ratio, CAST(length(text) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL")
def symbol_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.round(T.unusual_symbol_ratio(F.col("text")), 9).alias("unusual_symbol_ratio"), F.length("text").cast("bigint").alias("n"))


_GATE = Gate(min_avg_logprob=-1.0, max_no_speech_prob=0.6)
_DECIDED = f"""{_CLEANED},
n AS (SELECT *, len(regexp_extract_all(cleaned_text, '[^{_SP[1:-1]}]+')) AS words, CASE WHEN NOT isnan(duration) THEN duration END AS d,
      CASE WHEN NOT isnan(avg_logprob) THEN avg_logprob END AS lp, CASE WHEN NOT isnan(no_speech_prob) THEN no_speech_prob END AS ns FROM c),
d AS (SELECT id, source_folder, audio_path, cleaned_text, d AS duration, words, list_filter([
  CASE WHEN cleaned_text = '' THEN 'empty_cleaned_text' END, CASE WHEN cleaned_text = '' THEN 'marked_empty_after_cleaning' END,
  CASE WHEN words < 3 THEN 'word_count_too_low' END, CASE WHEN cleaned_text <> '' AND {_sql_odd('cleaned_text')} > 0.2 THEN 'too_many_unusual_symbols' END,
  CASE WHEN lp < -1.0 THEN 'avg_logprob_too_low' END, CASE WHEN ns > 0.6 THEN 'no_speech_prob_too_high' END,
  CASE WHEN d IS NULL THEN 'missing_duration' END, CASE WHEN d < 3.0 THEN 'duration_too_short' END, CASE WHEN d > 15.0 THEN 'duration_too_long' END], lambda x: x IS NOT NULL) AS rs FROM n)"""


def _decided(spark: SparkSession, sf: str) -> DataFrame:
    return gate.decisions(gate.cleaned(table(spark, sf, "raw_transcripts")), _GATE, extra=("source_folder",))


@query(f"WITH {_DECIDED} SELECT coalesce(id, '') AS id, len(rs) = 0 AS accepted, array_to_string(rs, ',') AS reasons, CAST(words AS BIGINT) AS word_count, CAST(length(cleaned_text) AS BIGINT) AS char_count, duration FROM d")
def filter_decisions(spark: SparkSession, sf: str) -> DataFrame:
    d = _decided(spark, sf)
    return d.select("id", "accepted", F.array_join("reject_reasons", ",").alias("reasons"), F.col("word_count").cast("bigint").alias("word_count"), F.col("char_count").cast("bigint").alias("char_count"), "duration")


@query(f"WITH {_DECIDED} SELECT unnest(rs) AS reason, count(*) AS n FROM d GROUP BY 1")
def reject_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return gate.histogram(_decided(spark, sf))


@query(f"WITH {_DECIDED}, h AS (SELECT unnest(rs) AS reason, count(*) AS n FROM d GROUP BY 1) SELECT count(*) AS total_rows, count(*) FILTER (len(rs) = 0) AS accepted_count, count(*) FILTER (len(rs) > 0) AS rejected_count, (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM h) AS reasons FROM d")
def filter_report(spark: SparkSession, sf: str) -> DataFrame:
    r = gate.report(_decided(spark, sf))
    said = F.transform("reject_reason_counts", lambda x: F.concat_ws("=", x["reason"], x["n"].cast("string")))
    return r.select("total_rows", "accepted_count", "rejected_count", F.array_join(said, ",").alias("reasons"))


# --- words and speakers -----------------------------------------------------------------------------------------

_STRIP = f"regexp_replace(coalesce(text, ''), '^{_SP}+|{_SP}+$', '', 'g')"
_TOKENS = f"""
u AS (SELECT DISTINCT file_id, "index" AS i, {_STRIP} AS text, start, "end", coalesce(type, 'word') AS type, speaker_id, CASE WHEN NOT isnan(logprob) AND NOT isinf(logprob) THEN logprob END AS logprob FROM stt_words),
ok AS (SELECT *, coalesce(text <> '' AND NOT isnan(start) AND NOT isinf(start) AND NOT isnan("end") AND NOT isinf("end") AND "end" > start, false) AS ok FROM u),
t AS (SELECT file_id, i, text, round(start, 3) AS s, round("end", 3) AS e, type, nullif(speaker_id, '') AS who, logprob,
      contains(lower(type), 'event') OR regexp_matches(text, '^\\s*[\\[(<].+[\\])>]\\s*$') AS event FROM ok WHERE ok),
k AS (SELECT *, NOT event AND lower(type) NOT IN ('spacing', 'space') AS speech FROM t)"""


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.normalise(table(spark, sf, "stt_words"))[0]


@query(f"WITH {_TOKENS} SELECT file_id, CAST(i AS BIGINT) AS idx, text, s AS start_s, e AS end_s, round(e - s, 3) AS duration, type, event, speech FROM k")
def token_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(spark, sf).select("file_id", F.col("index").cast("bigint").alias("idx"), "text", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "duration", "type", tokens.is_event().alias("event"), tokens.is_speech().alias("speech"))


@query(f"WITH {_TOKENS} SELECT file_id, count(*) AS tokens, count(*) FILTER (NOT ok) AS invalid FROM ok GROUP BY file_id")
def invalid_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.normalise(table(spark, sf, "stt_words"))[1]


_TURNS = _TOKENS + """,
p AS (SELECT *, lag(struct_pack(k := speech AND who IS NOT NULL, w := who, e := e)) OVER (PARTITION BY file_id ORDER BY s, e, i) AS b FROM k),
m AS (SELECT *, CASE WHEN b.k AND b.w = who AND greatest(0, s - b.e) <= 0.8 THEN 0 ELSE 1 END AS new FROM p),
n AS (SELECT * FROM m WHERE speech AND who IS NOT NULL),
r AS (SELECT *, sum(new) OVER (PARTITION BY file_id ORDER BY s, e, i ROWS UNBOUNDED PRECEDING) AS turn FROM n),
tu AS (SELECT file_id, CAST(turn AS BIGINT) AS turn, min(who) AS speaker_id, min(s) AS start_s, arg_max(e, (s, e, i)) AS end_s, count(*) FILTER (regexp_matches(text, '[\\p{L}\\p{N}_]')) AS word_count,
       trim(regexp_replace(regexp_replace(string_agg(text, ' ' ORDER BY s, e, i), '\\s+([,.?!:;])', '\\1', 'g'), '\\s+', ' ', 'g')) AS text FROM r GROUP BY file_id, turn)"""


@query(f"WITH {_TURNS} SELECT file_id, turn, speaker_id, start_s, end_s, round(end_s - start_s, 3) AS duration, word_count, text FROM tu")
def speaker_turns(spark: SparkSession, sf: str) -> DataFrame:
    t = tokens.turns(_tokens(spark, sf))
    return t.select("file_id", F.col("turn").cast("bigint").alias("turn"), "speaker_id", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "duration", "word_count", "text")


_STATS = _TURNS + """,
sb AS (SELECT file_id, who AS speaker_id, sum(CAST(round((e - s) * 1000) AS BIGINT)) AS ms, count(*) AS word_count, min(s) AS first_start, max(e) AS last_end FROM k WHERE speech AND who IS NOT NULL GROUP BY 1, 2),
st AS (SELECT file_id, speaker_id, count(*) AS turn_count, sum(CAST(round(round(end_s - start_s, 3) * 1000) AS BIGINT)) AS tms FROM tu GROUP BY 1, 2),
ss AS (SELECT sb.file_id, sb.speaker_id, ms / 1000 AS duration_seconds, round(ms / greatest(sum(ms) OVER (PARTITION BY sb.file_id), 1), 4) AS share, word_count, coalesce(turn_count, 0) AS turn_count,
       coalesce(floor((2 * tms + turn_count) / (2.0 * turn_count)) / 1000, 0) AS average_turn_duration_seconds, first_start, last_end FROM sb LEFT JOIN st USING (file_id, speaker_id))"""


@query(f"WITH {_STATS} SELECT * FROM ss")
def speaker_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.speaker_stats(_tokens(spark, sf)).drop("sample_utterances")


@query(f"WITH {_STATS}, q AS (SELECT file_id, count(*) AS total_timestamped_tokens, count(*) FILTER (speech AND who IS NULL) AS missing_speaker_word_count, count(*) FILTER (event) AS audio_event_count, count(DISTINCT CASE WHEN speech THEN who END) AS speaker_count FROM k GROUP BY 1), z AS (SELECT file_id, count(*) FILTER (NOT ok) AS invalid_word_count FROM ok GROUP BY 1) SELECT file_id, coalesce(total_timestamped_tokens, 0) AS total_timestamped_tokens, invalid_word_count, coalesce(speaker_count, 0) AS speaker_count, coalesce(missing_speaker_word_count, 0) AS missing_speaker_word_count, coalesce(audio_event_count, 0) AS audio_event_count FROM z LEFT JOIN q USING (file_id)")
def speaker_inspection(spark: SparkSession, sf: str) -> DataFrame:
    t, counts = tokens.normalise(table(spark, sf, "stt_words"))
    return tokens.inspection(t, counts)


_TARGET = _STATS + """,
rk AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY duration_seconds DESC, word_count DESC, speaker_id) AS pick FROM ss),
lost AS (SELECT file_id, count(*) FILTER (speech AND who IS NULL) AS n FROM k GROUP BY 1),
tg AS (SELECT a.file_id, a.speaker_id AS selected_speaker, a.share, max(b.share) AS other FROM rk a LEFT JOIN rk b ON a.file_id = b.file_id AND b.pick > 1 WHERE a.pick = 1 GROUP BY 1, 2, 3)"""


@query(f"WITH {_TARGET} SELECT file_id, selected_speaker, 'auto' AS selection_source, share, array_to_string(list_filter([CASE WHEN round(share - other, 10) <= 0.1 THEN 'close_second_speaker' END, CASE WHEN share < 0.45 THEN 'low_speaker_share' END, CASE WHEN n > 0 THEN 'missing_speaker_words' END], lambda x: x IS NOT NULL), ',') AS warnings FROM tg JOIN lost USING (file_id)")
def target_speaker(spark: SparkSession, sf: str) -> DataFrame:
    t, counts = tokens.normalise(table(spark, sf, "stt_words"))
    s = tokens.select_target(tokens.speaker_stats(t), Segmentation(), tokens.inspection(t, counts))
    return s.withColumn("warnings", F.array_join("selection_warnings", ",")).drop("selection_warnings")


# --- segments of words ------------------------------------------------------------------------------------------

_REGIONS = _TARGET + """,
rp AS (SELECT k.*, selected_speaker, speech AND who = selected_speaker AS keep FROM k JOIN tg USING (file_id)),
rb AS (SELECT *, lag(struct_pack(k := coalesce(keep, false), e := e)) OVER (PARTITION BY file_id ORDER BY s, e, i) AS b FROM rp),
rm AS (SELECT *, CASE WHEN b.k AND greatest(0, s - b.e) <= 0.8 THEN 0 ELSE 1 END AS new FROM rb),
rr AS (SELECT *, CAST(sum(new) OVER (PARTITION BY file_id ORDER BY s, e, i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS region FROM rm WHERE keep),
rg AS (SELECT *, row_number() OVER (PARTITION BY file_id, region ORDER BY s, e, i) - 1 AS pos FROM rr)"""


def _regions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t = durable(_tokens(spark, sf), "tokens")  # read by the statistics, the regions and the checks of neighbours
    return t, segmentation.regions(t, tokens.select_target(tokens.speaker_stats(t)))


@query(f"WITH {_REGIONS} SELECT file_id, region, CAST(pos AS BIGINT) AS pos, CAST(i AS BIGINT) AS idx, s AS start_s, e AS end_s FROM rg")
def regions(spark: SparkSession, sf: str) -> DataFrame:
    r = _regions(spark, sf)[1]
    return r.select("file_id", F.col("region").cast("bigint").alias("region"), F.col("pos").cast("bigint").alias("pos"), F.col("index").cast("bigint").alias("idx"), F.col("start").alias("start_s"), F.col("end").alias("end_s"))


def _in(col: str, words: tuple[str, ...]) -> str:
    return f"{col} IN (" + ", ".join(f"'{w}'" for w in words) + ")"


_FEATURES = _REGIONS + f""",
fw AS (SELECT *, regexp_replace(nfc_normalize(text), '[^\\p{{L}}\\p{{N}}_À-ỹ]+$', '') AS w, regexp_matches(text, '[.!?…]+["'')\\]]*$') AS fin FROM rg),
fl AS (SELECT *, lower(w) AS lw, lead(text) OVER o AS right_text, lead(w) OVER o AS rw, coalesce(lag(lower(w)) OVER o, '') AS l1, coalesce(lag(lower(w), 2) OVER o, '') AS l2, greatest(0, lead(s) OVER o - e) AS gap FROM fw WINDOW o AS (PARTITION BY file_id, region ORDER BY pos)),
ff AS (SELECT *, right_text IS NOT NULL AS hr, coalesce(right_text IS NOT NULL AND NOT fin, false) AS op, coalesce(gap >= 0.45, false) AS strong, coalesce(gap >= 0.25, false) AS medium, coalesce(regexp_matches(rw, '^[\\p{{Lu}}\\p{{Lt}}]'), false) AS up, coalesce(regexp_matches(rw, '^\\p{{Ll}}'), false) AS lo FROM fl),
fe AS (SELECT *, CASE WHEN fin THEN 8.0 ELSE 0 END + CASE WHEN NOT hr THEN 8.0 ELSE 0 END + CASE WHEN hr AND strong THEN 5.0 ELSE 0 END + CASE WHEN hr AND NOT strong AND medium THEN 2.5 ELSE 0 END - CASE WHEN op AND NOT medium THEN 4.0 ELSE 0 END - CASE WHEN op AND lo THEN 2.0 ELSE 0 END AS base,
  list_filter([CASE WHEN hr AND up AND regexp_matches(w, '^[\\p{{Lu}}\\p{{Lt}}]') THEN 'protected_capitalized_entity' END,
    CASE WHEN hr AND up AND {_in('lw', segmentation.DIRECTIONS)} THEN 'protected_direction_or_country_name' END,
    CASE WHEN hr AND up AND ({_in("trim(regexp_replace(l2 || ' ' || l1 || ' ' || lw, ' +', ' ', 'g'))", segmentation.ENTITY_PREFIXES)} OR {_in("trim(l1 || ' ' || lw)", segmentation.ENTITY_PREFIXES)} OR {_in('lw', segmentation.ENTITY_PREFIXES)}) THEN 'protected_entity_prefix' END,
    CASE WHEN hr AND NOT fin AND {_in('lower(rw)', segmentation.LEADING_CONNECTORS)} THEN 'protected_leading_connector' END,
    CASE WHEN hr AND {_in('lw', segmentation.TRAILING_CONNECTORS)} THEN 'protected_trailing_connector' END], lambda x: x IS NOT NULL) AS guards FROM ff)"""


@query(f"WITH {_FEATURES} SELECT file_id, region, CAST(pos AS BIGINT) AS pos, round(gap, 3) AS gap_after, fin AS is_final, CAST(base AS DOUBLE) AS base_score, array_to_string(guards, ',') AS protections FROM fe")
def boundary_features(spark: SparkSession, sf: str) -> DataFrame:
    f = segmentation.boundary_features(_regions(spark, sf)[1])
    return f.select("file_id", F.col("region").cast("bigint").alias("region"), F.col("pos").cast("bigint").alias("pos"), F.round("gap_after", 3).alias("gap_after"), "is_final", "base_score", F.array_join("protections", ",").alias("protections"))


# The walk: best end for every start among the words up to the first overlong sentence end, then following the ends.
_WALK = _FEATURES + """,
sx AS (SELECT a.file_id, a.region, a.pos AS i, min(b.pos) AS stop FROM fe a JOIN fe b ON a.file_id = b.file_id AND a.region = b.region AND b.pos >= a.pos AND b.fin AND round(b.e - a.s, 3) > 15 GROUP BY 1, 2, 3),
pr AS (SELECT a.file_id, a.region, a.pos AS i, b.pos AS j, b.e - a.s AS d, round(b.e - a.s, 3) AS r, b.base, b.fin FROM fe a LEFT JOIN sx ON a.file_id = sx.file_id AND a.region = sx.region AND a.pos = sx.i
       JOIN fe b ON a.file_id = b.file_id AND a.region = b.region AND b.pos >= a.pos AND b.pos <= coalesce(sx.stop, 1000000000) WHERE (b.fin OR NOT b.hr) AND len(b.guards) = 0),
sc AS (SELECT *, round(base + CASE WHEN d BETWEEN 5 AND 10 THEN 3 + greatest(0, 2 - abs(d - 7.5) * 0.35) WHEN d > 10 AND d <= 15 THEN 1 WHEN d >= 3 AND d < 5 THEN -1 ELSE 0 END + 1e-9, 3) AS score,
       CASE WHEN r BETWEEN 5 AND 10 THEN 0 WHEN r > 10 AND r <= 15 THEN 1 WHEN r > 15 AND fin THEN 2 WHEN r >= 3 AND r < 5 THEN 3 END AS bucket FROM pr WHERE d >= 3 AND (d <= 15 OR fin)),
be AS (SELECT file_id, region, i, j, score FROM (SELECT *, row_number() OVER (PARTITION BY file_id, region, i ORDER BY bucket, score DESC, r DESC, j) AS n FROM sc WHERE score >= 7 AND bucket IS NOT NULL) WHERE n = 1),
ra AS (SELECT file_id, region, max(pos) AS z FROM fe GROUP BY 1, 2),
wk AS (SELECT ra.file_id, ra.region, 0::BIGINT AS i, coalesce(j, z) AS j, score, 1 AS seg, z FROM ra LEFT JOIN be ON be.file_id = ra.file_id AND be.region = ra.region AND be.i = 0
       UNION ALL SELECT wk.file_id, wk.region, wk.j + 1, coalesce(be.j, wk.z), be.score, wk.seg + 1, wk.z FROM wk LEFT JOIN be ON be.file_id = wk.file_id AND be.region = wk.region AND be.i = wk.j + 1 WHERE wk.j < wk.z)"""


def _words_in_segments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t, r = _regions(spark, sf)
    return t, durable(segmentation.segments(segmentation.boundary_features(r)), "segments")


@query(f"WITH RECURSIVE {_WALK.strip()} SELECT file_id, region, CAST(seg AS BIGINT) AS segment, CAST(i AS BIGINT) AS first_pos, CAST(j AS BIGINT) AS last_pos, score AS boundary_score FROM wk")
def segments(spark: SparkSession, sf: str) -> DataFrame:
    w = _words_in_segments(spark, sf)[1]
    g = w.groupBy("file_id", "region", "segment").agg(F.min("pos").cast("bigint").alias("first_pos"), F.max("pos").cast("bigint").alias("last_pos"), F.first("boundary_score").alias("boundary_score"))
    return g.withColumns({"region": F.col("region").cast("bigint"), "segment": F.col("segment").cast("bigint")})


_LENGTH = "CASE WHEN d BETWEEN 5 AND 10 THEN 3 + greatest(0, 2 - abs(d - 7.5) * 0.35) WHEN d > 10 AND d <= 15 THEN 1 WHEN d >= 3 AND d < 5 THEN -1 ELSE 0 END"
_WEIGHED = _WALK + """,
wv AS (SELECT wk.file_id, wk.region, wk.i, b.pos AS j, b.e - a.s AS d, b.base, b.fin, b.hr, b.op, b.strong, b.medium, b.lo, b.guards, b.text AS left_text, b.right_text FROM wk JOIN fe a ON a.file_id = wk.file_id AND a.region = wk.region AND a.pos = wk.i
       LEFT JOIN sx ON sx.file_id = wk.file_id AND sx.region = wk.region AND sx.i = wk.i JOIN fe b ON b.file_id = wk.file_id AND b.region = wk.region AND b.pos BETWEEN wk.i AND coalesce(sx.stop, 1000000000))"""


@query(f"""WITH RECURSIVE {_WEIGHED.strip()} SELECT file_id, region, CAST(i AS BIGINT) AS start_pos, CAST(j AS BIGINT) AS end_pos, round(d, 3) AS duration, round(base + {_LENGTH} + 1e-9, 3) AS score, (fin OR NOT hr) AND len(guards) = 0 AND d >= 3 AND (d <= 15 OR fin) AS is_valid, left_text, right_text,
 array_to_string(list_sort(list_concat(guards, list_filter([CASE WHEN fin THEN 'sentence_punctuation' END, CASE WHEN NOT hr THEN 'region_end' END, CASE WHEN hr AND strong THEN 'strong_pause' END, CASE WHEN hr AND NOT strong AND medium THEN 'medium_pause' END, CASE WHEN op AND NOT medium THEN 'no_punctuation_or_pause' END, CASE WHEN op AND lo THEN 'lowercase_continuation' END, CASE WHEN op THEN 'not_sentence_boundary' END,
  CASE WHEN d BETWEEN 5 AND 10 THEN 'preferred_duration' WHEN d > 10 AND d <= 15 THEN 'extended_duration' WHEN d >= 3 AND d < 5 THEN 'short_duration' END, CASE WHEN d < 3 THEN 'duration_too_short' END, CASE WHEN d > 15 AND NOT fin THEN 'duration_too_long' END], lambda x: x IS NOT NULL))), ',') AS reasons FROM wv""")
def boundary_scores(spark: SparkSession, sf: str) -> DataFrame:
    b = segmentation.boundary_scores(_words_in_segments(spark, sf)[1])
    return b.select("file_id", F.col("region").cast("bigint").alias("region"), F.col("start_pos").cast("bigint").alias("start_pos"), F.col("end_pos").cast("bigint").alias("end_pos"), "duration", "score", "is_valid", "left_text", "right_text", F.array_join("reasons", ",").alias("reasons"))


_CANDS = _WALK + """,
ca AS (SELECT wk.file_id, wk.region, seg, arg_min(s, pos) AS a, arg_max(e, pos) AS b, any_value(selected_speaker) AS target, any_value(wk.score) AS score, count(*) FILTER (regexp_matches(text, '[\\p{L}\\p{N}_]')) AS word_count, floor((2 * sum(CAST(round(logprob * 10000) AS BIGINT)) + count(logprob)) / (2.0 * count(logprob))) / 10000 AS avg_logprob,
       arg_max(fin, pos) AS fin, trim(regexp_replace(regexp_replace(string_agg(text, ' ' ORDER BY pos), '\\s+([,.?!:;])', '\\1', 'g'), '\\s+', ' ', 'g')) AS text FROM wk JOIN fe ON fe.file_id = wk.file_id AND fe.region = wk.region AND fe.pos BETWEEN wk.i AND wk.j GROUP BY 1, 2, 3),
cp AS (SELECT *, greatest(0, a - 0.05) AS p0, b + 0.05 AS p1 FROM ca)"""


@query(f"WITH RECURSIVE {_CANDS.strip()} SELECT file_id, region, CAST(seg AS BIGINT) AS segment, round(p0, 3) AS start_s, round(p1, 3) AS end_s, round(p1 - p0, 3) AS duration, text, word_count, avg_logprob FROM cp")
def segment_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = segmentation.candidates(_words_in_segments(spark, sf)[1])
    return c.select("file_id", F.col("region").cast("bigint").alias("region"), F.col("segment").cast("bigint").alias("segment"), F.col("start").alias("start_s"), F.col("end").alias("end_s"), "duration", "text", "word_count", "avg_logprob")


_NEAR = _CANDS + """,
nb AS (SELECT c.file_id, c.region, c.seg, coalesce(max(CASE WHEN k.s < c.b AND k.e > c.a AND k.event THEN 1 END), 0) = 1 AS ev,
   arg_min(CASE WHEN k.who IS NULL THEN 'unknown_speaker_overlap' ELSE 'mixed_speaker_overlap' END, (k.s, k.e, k.i)) FILTER (k.s < c.b AND k.e > c.a AND k.speech AND k.who IS DISTINCT FROM c.target) AS ov,
   coalesce(arg_max((k.event OR (k.speech AND k.who IS DISTINCT FROM c.target)) AND c.a - k.e < 0.2, (k.e, -k.s, -k.i)) FILTER (k.e <= c.a), false) AS le,
   coalesce(arg_min((k.event OR (k.speech AND k.who IS DISTINCT FROM c.target)) AND k.s - c.b < 0.2, (k.s, k.e, k.i)) FILTER (k.s >= c.b), false) AS tr
   FROM cp c JOIN k ON k.file_id = c.file_id WHERE c.score IS NOT NULL GROUP BY 1, 2, 3),
vd AS (SELECT cp.*, nb.ov, CASE WHEN cp.score IS NULL THEN ['no_safe_semantic_boundary'] ELSE list_sort(list_filter([CASE WHEN ev THEN 'audio_event_overlap' END, CASE WHEN round(p1, 3) - round(p0, 3) > 15 AND NOT fin THEN 'duration_too_long' END,
   CASE WHEN round(p1, 3) - round(p0, 3) < 3 THEN 'duration_too_short' END, CASE WHEN le THEN 'risky_leading_transition' END, CASE WHEN tr THEN 'risky_trailing_transition' END, CASE WHEN word_count < 3 THEN 'word_count_too_low' END, ov], lambda x: x IS NOT NULL)) END AS rs
   FROM cp LEFT JOIN nb USING (file_id, region, seg))"""


@query(f"WITH RECURSIVE {_NEAR.strip()} SELECT file_id, region, CAST(seg AS BIGINT) AS segment, array_to_string(rs, ',') AS reject_reasons FROM vd")
def validated_segments(spark: SparkSession, sf: str) -> DataFrame:
    t, w = _words_in_segments(spark, sf)
    v = segmentation.validate(segmentation.candidates(w), t)
    return v.select("file_id", F.col("region").cast("bigint").alias("region"), F.col("segment").cast("bigint").alias("segment"), F.array_join("reject_reasons", ",").alias("reject_reasons"))


@query(f"WITH RECURSIVE {_NEAR.strip()} SELECT file_id, count(*) FILTER (len(rs) = 0) AS segment_count, count(*) FILTER (len(rs) > 0) AS rejected_count, round(sum(CASE WHEN len(rs) = 0 THEN round(p1 - p0, 3) ELSE 0 END), 3) AS accepted_duration_seconds FROM vd GROUP BY 1")
def segmentation_report(spark: SparkSession, sf: str) -> DataFrame:
    t, w = _words_in_segments(spark, sf)
    return segmentation.report(segmentation.validate(segmentation.candidates(w), t)).drop("reject_reason_counts")


# --- segments of spans ------------------------------------------------------------------------------------------

_VALID = """
v AS (SELECT DISTINCT file_id, start AS s, "end" AS e FROM vad_segments WHERE isfinite(start) AND isfinite("end") AND start >= 0 AND "end" > start),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY s, e) AS n FROM v)"""
# A fold in recursion: one step a span, carrying the segment that is open.
_MERGE = "WITH RECURSIVE " + _VALID.strip() + """,
f AS (SELECT file_id, n, s, e, false AS merged, 1 AS seg FROM o WHERE n = 1
      UNION ALL SELECT o.file_id, o.n, CASE WHEN t.take THEN f.s ELSE o.s END, o.e, t.take, CASE WHEN t.take THEN f.seg ELSE f.seg + 1 END
      FROM f JOIN o ON o.file_id = f.file_id AND o.n = f.n + 1, LATERAL (SELECT f.e - f.s < 3 AND greatest(0, o.s - f.e) <= 0.5 AND o.e - f.s <= 15 AS take) t),
g AS (SELECT file_id, seg, arg_max(s, n) AS s, arg_max(e, n) AS e, bool_or(merged) AS merged FROM f GROUP BY 1, 2)"""


@query(_MERGE + " SELECT file_id, s AS start_s, e AS end_s, CASE WHEN merged THEN 'vad_merged' ELSE 'vad_raw' END AS source FROM g")
def merge_spans(spark: SparkSession, sf: str) -> DataFrame:
    return spans.merge_short(spans.valid_spans(table(spark, sf, "vad_segments"))).withColumnsRenamed({"start": "start_s", "end": "end_s"})


_SPLIT = """,
h AS (SELECT *, CASE WHEN e - s > {hi} THEN greatest(2, CAST(floor((e - s) / {to} + 0.999999) AS BIGINT), CAST(ceil((e - s) / {hi}) AS BIGINT)) ELSE 1 END AS c FROM {src}),
x AS (SELECT *, unnest(range(c)) AS i, (e - s) / c AS d FROM h),
y AS (SELECT file_id, CASE WHEN c = 1 THEN s ELSE s + d * i END AS s, CASE WHEN i = c - 1 THEN e ELSE s + d * (i + 1) END AS e, CASE WHEN c = 1 THEN src ELSE 'vad_split' END AS source FROM x)"""
_SHORT = Spans(max_sec=6.0, ideal_max=6.0, force_split_target_sec=2.5)


@query("WITH " + _VALID.strip() + ", w AS (SELECT *, 'vad_raw' AS src FROM v)" + _SPLIT.format(hi="6.0", to="2.5", src="w") + " SELECT file_id, round(s, 6) AS start_s, round(e, 6) AS end_s, source FROM y")
def split_spans(spark: SparkSession, sf: str) -> DataFrame:
    v = spans.valid_spans(table(spark, sf, "vad_segments")).withColumn("source", F.lit("vad_raw"))
    return spans.split_long(v, _SHORT).select("file_id", F.round("start", 6).alias("start_s"), F.round("end", 6).alias("end_s"), "source")


@query(_MERGE + ", w AS (SELECT *, CASE WHEN merged THEN 'vad_merged' ELSE 'vad_raw' END AS src FROM g)" + _SPLIT.format(hi="15.0", to="8.0", src="w") + """
SELECT file_id, lpad(CAST(row_number() OVER (PARTITION BY file_id ORDER BY s, e) AS VARCHAR), 6, '0') AS id, round(s + 1e-9, 3) AS start_s, round(e + 1e-9, 3) AS end_s, source FROM y WHERE e - s BETWEEN 3 AND 15""")
def number_segments(spark: SparkSession, sf: str) -> DataFrame:
    b = spans.build(spans.valid_spans(table(spark, sf, "vad_segments")))
    return b.select("file_id", "id", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "source")


# --- signal -----------------------------------------------------------------------------------------------------

_CFG = Signal(silence_threshold_dbfs=-30.0)


def _clips(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    # the vectors stand in for clips: some get a silent beginning
    quiet = F.transform("embedding", lambda x, i: F.when(i < F.col("vec_id") % 9, F.lit(0.0).cast("float")).otherwise(x))
    return e.select("vec_id", quiet.alias("samples"), F.lit(16000).alias("sample_rate"), (2.0 + F.col("vec_id") % 11).alias("duration"))


_CLIPS = "cl AS (SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i - 1 < vec_id % 9 THEN 0.0 ELSE CAST(x AS DOUBLE) END) AS a, CAST(2.0 + vec_id % 11 AS DOUBLE) AS duration FROM embeddings)"
_LEVELS = _CLIPS + """,
ab AS (SELECT *, list_transform(a, lambda x: abs(x)) AS b, len(a) AS n, 10 ** (-30.0 / 20) AS thr FROM cl),
lv AS (SELECT vec_id, duration, 20 * log10(greatest(sqrt(list_sum(list_transform(a, lambda x: x * x)) / n), 1e-12)) AS rms_dbfs, 20 * log10(greatest(list_max(b), 1e-12)) AS peak_dbfs,
  len(list_filter(b, lambda x: x >= 0.999)) / n AS clipping_ratio, 1 - len(list_filter(b, lambda x: x >= thr)) / n AS silence_ratio,
  coalesce(list_position(list_transform(b, lambda x: x >= thr), true) - 1, n) / 16000 AS leading_silence_sec, coalesce(list_position(list_transform(list_reverse(b), lambda x: x >= thr), true) - 1, n) / 16000 AS trailing_silence_sec FROM ab)"""
_LV = ("rms_dbfs", "peak_dbfs", "clipping_ratio", "silence_ratio", "leading_silence_sec", "trailing_silence_sec")


@query(f"WITH {_LEVELS} SELECT vec_id, {', '.join(f'round({c}, 6) AS {c}' for c in _LV)} FROM lv")
def signal_metrics(spark: SparkSession, sf: str) -> DataFrame:
    c = _clips(spark, sf)
    m = signal.level_metrics(F.col("samples"), F.col("sample_rate"), _CFG)
    return c.select("vec_id", *[F.round(m[k], 6).alias(k) for k in _LV])


_DFT = _CLIPS + """,
hn AS (SELECT vec_id, list_transform(a, lambda x, i: x * (0.5 - 0.5 * cos(2 * pi() * (i - 1) / (len(a) - 1)))) AS h FROM cl),
mg AS (SELECT vec_id, list_transform(range(len(h) // 2 + 1), lambda k: sqrt(list_sum(list_transform(h, lambda x, i: x * cos(2 * pi() * k * (i - 1) / len(h)))) ** 2 + list_sum(list_transform(h, lambda x, i: x * sin(2 * pi() * k * (i - 1) / len(h)))) ** 2) + 1e-12) AS m, len(h) AS n FROM hn)"""


@query(f"WITH {_DFT} SELECT vec_id, round(exp(list_avg(list_transform(m, lambda x: ln(x)))) / list_avg(m), 4) AS spectral_flatness, round(list_sum(list_transform(m, lambda x, k: CASE WHEN (k - 1) * 16000.0 / n >= 5000 THEN x ELSE 0 END)) / list_sum(m), 4) AS high_freq_energy_ratio FROM mg")
def spectral_metrics(spark: SparkSession, sf: str) -> DataFrame:
    s = _clips(spark, sf).withColumn("s", signal.spectrum(F.col("samples"), F.col("sample_rate")))
    return s.select("vec_id", F.round("s.spectral_flatness", 4).alias("spectral_flatness"), F.round("s.high_freq_energy_ratio", 4).alias("high_freq_energy_ratio"))


def _sql_labels(src: str) -> str:
    m = ("clipping_ratio", "silence_ratio", "leading_silence_sec", "trailing_silence_sec", "spectral_flatness", "high_freq_energy_ratio")
    hi, lo = (0.01, 0.35, 0.35, 0.35, 0.20, 0.30), (0.002, 0.20, 0.15, 0.15, 0.10, 0.18)
    bad = ("possible_clipping", "excessive_internal_silence", "leading_silence_too_long", "trailing_silence_too_long", "noise_or_reverb_proxy", "high_frequency_noise_proxy")
    look = ("possible_clipping_review", "internal_silence_review", "leading_silence_review", "trailing_silence_review", "noise_or_reverb_review", "high_frequency_noise_review")
    known = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in signal.METRICS)
    b = ", ".join(f"CASE WHEN known AND {c} > {x} THEN '{n}' END" for c, x, n in zip(m, hi, bad))
    r = ", ".join(f"CASE WHEN known AND {c} > {y} AND {c} <= {x} THEN '{n}' END" for c, x, y, n in zip(m, hi, lo, look))
    return f"""kn AS (SELECT *, coalesce({known}, false) AS known, coalesce(duration, 0) AS du FROM {src}),
lb AS (SELECT *, list_filter([CASE WHEN du < 3 THEN 'duration_too_short' END, CASE WHEN du > 10 THEN 'duration_too_long' END, {b}, CASE WHEN NOT known THEN 'audio_analysis_failed' END], lambda x: x IS NOT NULL) AS bad,
 list_filter([CASE WHEN known AND rms_dbfs < -28 THEN 'audio_too_quiet' END, CASE WHEN known AND rms_dbfs >= -28 AND rms_dbfs < -24 THEN 'audio_quiet_review' END, {r}], lambda x: x IS NOT NULL) AS look FROM kn),
fin AS (SELECT *, CASE WHEN len(bad) > 0 THEN 'bad' WHEN len(look) > 0 THEN 'review' ELSE 'good' END AS label, CASE WHEN len(bad) > 0 THEN bad ELSE look END AS why FROM lb)"""


_QM = """qd AS (SELECT DISTINCT * EXCLUDE (ingested_at) FROM quality_metrics), ad AS (SELECT DISTINCT id, duration FROM raw_transcripts), qj AS (SELECT qd.*, ad.duration FROM qd LEFT JOIN ad USING (id))"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "quality_metrics").drop("ingested_at", "quality_label").distinct()
    d = table(spark, sf, "raw_transcripts").select("id", "duration").distinct()
    return signal.labels(q.join(d, "id", "left"))


@query(f"WITH {_QM.replace('EXCLUDE (ingested_at)', 'EXCLUDE (ingested_at, quality_label)')}, {_sql_labels('qj')} SELECT id, label AS quality_label, array_to_string(why, ',') AS quality_reasons FROM fin")
def quality_label(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select("id", "quality_label", F.array_join("quality_reasons", ",").alias("quality_reasons"))


@query(f"WITH {_QM.replace('EXCLUDE (ingested_at)', 'EXCLUDE (ingested_at, quality_label)')}, {_sql_labels('qj')} SELECT label AS quality_label, count(*) AS n, round(sum(CAST(round(coalesce(duration, 0) * 1000) AS BIGINT)) / 1000, 3) AS duration_seconds FROM fin GROUP BY 1")
def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    return signal.label_report(_labelled(spark, sf))


@query(f"WITH {_QM.replace('EXCLUDE (ingested_at)', 'EXCLUDE (ingested_at, quality_label)')}, {_sql_labels('qj')} SELECT unnest(why) AS reason, count(*) AS n FROM fin GROUP BY 1")
def quality_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return gate.histogram(_labelled(spark, sf), "quality_reasons")


@query("""WITH u AS (UNPIVOT (SELECT """ + ", ".join(signal.METRICS) + """ FROM quality_metrics) ON COLUMNS(*) INTO NAME metric VALUE value),
v AS (SELECT metric, list_sort(list(value)) AS l, count(*) AS n, sum(CAST(round(value * 1000000) AS HUGEINT)) AS s FROM u WHERE isfinite(value) GROUP BY 1)
SELECT metric, round(l[1], 6) AS min, round(l[1 + CAST(round_even((n - 1) * 0.5, 0) AS BIGINT)], 6) AS p50, round(l[1 + CAST(round_even((n - 1) * 0.9, 0) AS BIGINT)], 6) AS p90, round(l[1 + CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)], 6) AS p95, round(l[n], 6) AS max, round(CAST(s AS DOUBLE) / n / 1e6, 6) AS avg FROM v""")
def metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return signal.metric_summary(table(spark, sf, "quality_metrics"), list(signal.METRICS))


# --- datasets ---------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT q.id, c.audio_path, r.text, coalesce(r.language, 'vi') AS language, c.duration, r.speaker_id FROM (SELECT DISTINCT id, audio_path, duration FROM cleaned_transcripts) c JOIN (SELECT DISTINCT id FROM quality_metrics) q USING (id) JOIN (SELECT DISTINCT id, text, language, speaker_id FROM raw_transcripts) r USING (id)")
def transcript_join(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "quality_metrics").select("id").distinct()
    m = table(spark, sf, "cleaned_transcripts").select("id", "audio_path", "duration").distinct().join(q, "id", "left_semi")
    seg = table(spark, sf, "raw_transcripts").select("id", "text", "language", "avg_logprob", "speaker_id", "start", "end")
    return dataset.transcripts(m, seg).select("id", "audio_path", "text", "language", "duration", "speaker_id")


_PREV = """
pv AS (SELECT id, CASE WHEN hash_no % 7 = 0 THEN NULL ELSE audio_path END AS audio_path, text, error, ingested_at FROM (SELECT *, CAST(right(id, 9) AS BIGINT) AS hash_no FROM raw_transcripts) WHERE coalesce(error, '') = '' AND (coalesce(id, '') <> '' OR coalesce(audio_path, '') <> '')),
mf AS (SELECT DISTINCT id, CASE WHEN CAST(right(id, 9) AS BIGINT) % 5 = 0 THEN './' || audio_path ELSE audio_path END AS audio_path FROM cleaned_transcripts),
bp AS (SELECT audio_path, arg_max(text, ingested_at) AS text FROM pv WHERE coalesce(audio_path, '') <> '' GROUP BY 1),
bi AS (SELECT id, arg_max(text, ingested_at) AS text, arg_max(coalesce(audio_path, '') <> '', ingested_at) AS p FROM pv GROUP BY 1)"""


@query(f"WITH {_PREV.strip()} SELECT mf.id, mf.audio_path, bp.audio_path IS NOT NULL OR (bi.id IS NOT NULL AND NOT bi.p) AS reused, CASE WHEN bp.audio_path IS NOT NULL THEN bp.text WHEN NOT bi.p THEN bi.text END AS text FROM mf LEFT JOIN bp ON bp.audio_path = regexp_replace(mf.audio_path, '^\\./', '') LEFT JOIN bi ON bi.id = mf.id")
def resume_join(spark: SparkSession, sf: str) -> DataFrame:
    no = F.substring("id", -9, 9).cast("bigint")
    p = table(spark, sf, "raw_transcripts").withColumn("audio_path", F.when(no % 7 == 0, None).otherwise(F.col("audio_path")))
    m = table(spark, sf, "cleaned_transcripts").select("id", F.when(no % 5 == 0, F.concat(F.lit("./"), "audio_path")).otherwise(F.col("audio_path")).alias("audio_path")).distinct()
    return dataset.resume(m, p, "ingested_at").select("id", "audio_path", "reused", "text")


@query("SELECT regexp_extract(audio_path, '([^/]*)$', 1) || '|' || trim(translate(cleaned_text, chr(13) || chr(10) || '|', '   ')) AS line FROM (SELECT DISTINCT id, audio_path, cleaned_text FROM accepted)")
def metadata_lines(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.metadata_lines(_accepted(spark, sf))


def _accepted(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.check_accepted(table(spark, sf, "accepted").drop("ingested_at").dropDuplicates(["id"]))


@query("SELECT id, replace(audio_path, 'data/', '') AS audio_filepath, cleaned_text AS text, duration FROM (SELECT DISTINCT id, audio_path, cleaned_text, duration FROM accepted)")
def manifest_export(spark: SparkSession, sf: str) -> DataFrame:
    lines = dataset.manifest_lines(_accepted(spark, sf), "data")
    return lines.select(F.from_json("line", "id string, audio_filepath string, text string, duration double").alias("r")).select("r.*")


@query("WITH a AS (SELECT DISTINCT id, duration FROM accepted), s AS (SELECT count(*) AS n, sum(CAST(round(duration * 1000) AS BIGINT)) / 1000 AS t, min(duration) AS lo, max(duration) AS hi FROM a) SELECT n AS total_accepted, round(t, 3) AS total_duration_seconds, round(t / 3600, 4) AS total_duration_hours, round(t / n, 3) AS average_duration_seconds, round(lo, 3) AS min_duration_seconds, round(hi, 3) AS max_duration_seconds FROM s")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.summary(_accepted(spark, sf))


@query("SELECT source_folder || '_' || id AS id, 'wavs/' || source_folder || '_' || regexp_extract(audio_path, '([^/]*)$', 1) AS audio_path, id AS source_id, source_folder FROM (SELECT DISTINCT id, source_folder, audio_path FROM accepted)")
def consolidate(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.consolidate(_accepted(spark, sf)).select("id", "audio_path", "source_id", "source_folder")


@query("WITH a AS (SELECT DISTINCT id, source_folder, duration FROM accepted) SELECT source_folder, count(*) AS row_count, sum(CAST(round(duration * 1000) AS BIGINT)) / 1000 AS duration_seconds FROM a GROUP BY ROLLUP (source_folder)")
def consolidation_report(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.consolidation_report(_accepted(spark, sf))


@query("SELECT regexp_extract(audio_path, '([^/]*)$', 1) AS name, cleaned_text AS text FROM (SELECT DISTINCT id, audio_path, cleaned_text FROM accepted) WHERE trim(cleaned_text) <> ''")
def metadata_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = _accepted(spark, sf).select(F.concat_ws("|", dataset.base_name(F.col("audio_path")), "cleaned_text").alias("line"))
    return dataset.parse_metadata(lines)


@query("WITH s AS (SELECT DISTINCT audio_path AS p FROM raw_transcripts), n AS (SELECT p, regexp_extract(p, '([^/]*)/*$', 1) AS n FROM s), t AS (SELECT p, regexp_replace(regexp_replace(regexp_replace(n, '^(.+)\\.[^.]*$', '\\1'), '[^A-Za-z0-9._\\-]+', '_', 'g'), '^[._\\-]+|[._\\-]+$', '', 'g') AS stem FROM n) SELECT p AS audio_path, CASE WHEN stem = '' THEN 'audio' ELSE stem END AS stem FROM t")
def safe_stem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_transcripts").select("audio_path").distinct().select("audio_path", T.safe_stem(F.col("audio_path")).alias("stem"))


@query(f"WITH {_QM.replace('EXCLUDE (ingested_at)', 'EXCLUDE (ingested_at, quality_label)')}, {_sql_labels('qj')} SELECT id, label AS quality_label FROM fin WHERE label IN ('good', 'review')")
def include_review(spark: SparkSession, sf: str) -> DataFrame:
    from voxloom.plans import pipeline

    q = _labelled(spark, sf).withColumn("start", F.col("duration"))
    return pipeline.choose(q, include_review=True).select("id", "quality_label")


@query("SELECT DISTINCT file_id FROM vad_segments WHERE file_id IS NOT NULL AND file_id NOT IN (SELECT file_id FROM raw_transcripts WHERE file_id IS NOT NULL GROUP BY file_id HAVING count(*) >= 20)")
def skip_done(spark: SparkSession, sf: str) -> DataFrame:
    """Recordings with less than twenty clips count as not yet done."""
    from voxloom.plans import pipeline

    done = table(spark, sf, "raw_transcripts").groupBy("file_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 20")
    return pipeline.skip_done(table(spark, sf, "vad_segments").select("file_id").where("file_id IS NOT NULL").distinct(), done)


_MERGED = """WITH a AS (SELECT DISTINCT id, source_folder, cleaned_text FROM accepted WHERE trim(cleaned_text) <> ''),
n AS (SELECT *, source_folder || '_' || right(id, 2) AS stem, dense_rank() OVER (ORDER BY source_folder) AS source_no FROM a),
k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY source_no, id) AS k FROM n)"""


@query(_MERGED + " SELECT right(id, 2) || '.wav' AS source_name, CASE WHEN k = 1 THEN stem ELSE stem || '_' || k END || '.wav' AS name, cleaned_text AS text FROM k")
def merge_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Every source folder as one metadata file whose file names (two digits) collide."""
    a = _accepted(spark, sf).where(T.strip(F.col("cleaned_text")) != "")
    line = F.concat(F.substring("id", -2, 2), F.lit(".wav|"), "cleaned_text")
    lines = a.select(F.col("source_folder").alias("source"), F.col("source_folder").alias("source_no"), F.col("id").alias("line_no"), line.alias("line"))
    return dataset.merge_metadata(lines).select("source_name", "name", "text")


@query("SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"))
