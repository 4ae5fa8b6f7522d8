"""Sentence-like segments of one target speaker out of a word stream, with scored boundaries and checked neighbours.

The score of ending a segment at word j that began at word i is B(j) + D(length):
all that depends on j alone (marks, pauses, protections) is computed once per
word with windows; only the walk from segment to segment is sequential and runs
over the words of one region in Arrow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from voxloom.functions import text as T
from voxloom.operators import tokens as K
from voxloom.runtime import durable
from voxloom.settings import Segmentation, Spans

# Words before which, or after which, a sentence does not end (Vietnamese).
ENTITY_PREFIXES = (
    "anh", "bà", "ban", "bộ", "bộ trưởng", "công ty", "cộng hòa", "đảng", "đội", "đội tuyển", "giáo sư", "huyện", "ông", "phường",
    "quận", "sở", "tập đoàn", "thành phố", "thị xã", "thủ tướng", "tiến sĩ", "tỉnh", "trường", "xã",
)
TRAILING_CONNECTORS = (
    "ai", "anh", "bằng", "bị", "các", "cái", "cho", "của", "đã", "đang", "để", "đến", "được", "gồm", "hay", "khi", "là", "mà", "một",
    "nên", "những", "ở", "sẽ", "tại", "theo", "thì", "trong", "và", "về", "với",
)
LEADING_CONNECTORS = ("bởi", "cho", "của", "để", "hoặc", "là", "mà", "nên", "nhưng", "rằng", "thì", "và", "vì", "với")
DIRECTIONS = ("đông", "tây", "nam", "bắc", "việt")

#: Buckets of time, by size class: a token lies in at most two buckets of the least class that is as long as it.
BUCKETS_SEC = (*(30.0 * 64.0**k for k in range(7)), float("inf"))


def regions(tokens: DataFrame, target: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """Words of each file's target speaker with ``region`` and ``pos`` (from 0 within it); any other token ends a region."""
    t = tokens.join(target.select("file_id", "selected_speaker"), "file_id")
    who = K.speaker(cfg)
    r = K.runs(t, K.is_speech() & (who == F.col("selected_speaker")), who, cfg.max_word_gap_sec).withColumnRenamed("run", "region")
    return r.withColumn("pos", F.row_number().over(W.partitionBy("file_id", "region").orderBy(*K.ORDER)) - 1)


def boundary_features(r: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """Adds what ending a segment at each word is worth by itself: right_text, gap_after, is_final, base_score, base_reasons, protections."""
    by = W.partitionBy("file_id", "region").orderBy("pos")
    w = T.bare_word(T.nfc(F.col("text")))
    r = r.withColumn("_w", w)
    low = F.lower("_w")
    r = r.withColumns({"right_text": F.lead("text").over(by), "_r": F.lead("_w").over(by), "_l1": F.lag(low).over(by), "_l2": F.lag(low, 2).over(by), "_low": low, "gap_after": F.greatest(F.lit(0.0), F.lead("start").over(by) - F.col("end")), "is_final": T.sentence_final(F.col("text"))})
    has_right = F.col("right_text").isNotNull()
    open_ = has_right & ~F.col("is_final")
    upper = T.starts_upper(F.col("_r"))
    phrase = lambda *c: F.array_join(F.filter(F.array(*[F.coalesce(F.col(x), F.lit("")) for x in c]), lambda x: x != ""), " ")
    guards = []
    if cfg.protect_named_entities:
        guards += [
            (T.starts_upper(F.col("_w")) & upper, "protected_capitalized_entity"),
            ((phrase("_l2", "_l1", "_low").isin(*ENTITY_PREFIXES) | phrase("_l1", "_low").isin(*ENTITY_PREFIXES) | F.col("_low").isin(*ENTITY_PREFIXES)) & upper, "protected_entity_prefix"),
            (F.col("_low").isin(*DIRECTIONS) & upper, "protected_direction_or_country_name"),
        ]
    if cfg.protect_connector_phrases:
        guards += [(F.col("_low").isin(*TRAILING_CONNECTORS), "protected_trailing_connector"), (F.lower("_r").isin(*LEADING_CONNECTORS) & ~F.col("is_final"), "protected_leading_connector")]
    named = lambda pairs: F.array_sort(F.array_compact(F.array(*[F.when(has & c, F.lit(n)) for has, c, n in pairs])))
    strong, medium = F.col("gap_after") >= cfg.pause_strong_sec, F.col("gap_after") >= cfg.pause_medium_sec
    lower = F.col("_r").rlike(r"^\p{Ll}")
    yes = F.lit(True)
    why = [
        (yes, F.col("is_final"), "sentence_punctuation"), (~has_right, yes, "region_end"), (has_right, strong, "strong_pause"), (has_right, ~strong & medium, "medium_pause"),
        (open_, ~medium, "no_punctuation_or_pause"), (open_, lower, "lowercase_continuation"), (open_, yes, "not_sentence_boundary"),
    ]
    points = lambda c, x: F.when(F.coalesce(c, F.lit(False)), F.lit(float(x))).otherwise(0.0)
    score = (
        points(F.col("is_final"), cfg.sentence_punctuation_weight) + points(~has_right, cfg.sentence_punctuation_weight)
        + points(has_right & strong, cfg.pause_strong_weight) + points(has_right & ~strong & medium, cfg.pause_medium_weight)
        + points(open_ & ~medium, -4.0) + points(open_ & lower, -2.0)
    )
    return r.withColumns({"base_score": score, "base_reasons": named(why), "protections": named([(has_right, c, n) for c, n in guards])}).drop("_w", "_r", "_l1", "_l2", "_low")


def _length_score(d: float, cfg: Segmentation, lo: float, hi: float) -> tuple[float, list[str]]:
    if cfg.preferred_min_sec <= d <= cfg.preferred_max_sec:
        return 3.0 + max(0.0, 2.0 - abs(d - (cfg.preferred_min_sec + cfg.preferred_max_sec) / 2) * 0.35), ["preferred_duration"]
    if cfg.preferred_max_sec < d <= hi:
        return 1.0, ["extended_duration"]
    if lo <= d < cfg.preferred_min_sec:
        return -1.0, ["short_duration"]
    return 0.0, []


def walk(start: list[float], end: list[float], base: list[float], final: list[bool], closed: list[bool], guarded: list[bool], cfg: Segmentation, lo: float, hi: float) -> list[tuple[int, int, float | None]]:
    """Segments (first word, last word, score) of one region in order; a rest without a safe boundary has score None and ends the walk.

    ``closed``: the word ends a sentence or the region. Among safe boundaries
    a preferred length beats a longer one, that an overlong sentence, that a
    short one; then the higher score, the greater length, the earlier word.
    """
    out: list[tuple[int, int, float | None]] = []
    i, n = 0, len(start)
    while i < n:
        best = None
        for j in range(i, n):
            d = end[j] - start[i]
            r = round(d, 3)
            if closed[j] and not guarded[j] and not (d < lo and not cfg.allow_short_clips) and not (d > hi and not final[j]):
                s = round(base[j] + _length_score(d, cfg, lo, hi)[0] + 1e-9, 3)  # decimal ties go up
                bucket = 0 if cfg.preferred_min_sec <= r <= cfg.preferred_max_sec else 1 if cfg.preferred_max_sec < r <= hi else 2 if r > hi and final[j] else 3 if lo <= r < cfg.preferred_min_sec else None
                if s >= cfg.min_boundary_score and bucket is not None and (best is None or (-bucket, s, r) > best[:3]):
                    best = (-bucket, s, r, j)
            if r > hi and final[j]:
                break
        if best is None:
            out.append((i, n - 1, None))
            break
        out.append((i, best[3], best[1]))
        i = best[3] + 1
    return out


def segments(features: DataFrame, cfg: Segmentation = Segmentation(), spans: Spans = Spans()) -> DataFrame:
    """Adds ``segment`` (from 1 within a region) and ``boundary_score`` to every word; the rest of a region without a safe boundary has a null score.

    Regions follow one another in sorted streams; one region is held at a time.
    """
    lo, hi = spans.min_sec, min(spans.max_sec, cfg.semantic_max_sec)
    src = features.select("file_id", "region", "pos", "index", "text", "start", "end", "logprob", "selected_speaker", "base_score", "is_final", F.col("right_text").isNull().alias("_last"), (F.size("protections") > 0).alias("_guarded"), "base_reasons", "protections", "right_text", "gap_after")
    src = src.repartition("file_id", "region").sortWithinPartitions("file_id", "region", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def cut(t: pa.Table) -> Iterator[pa.RecordBatch]:
            col = {c: t.column(c).to_pylist() for c in ("start", "end", "base_score", "is_final", "_last", "_guarded")}
            closed = [f or x for f, x in zip(col["is_final"], col["_last"])]
            seg, score = [0] * t.num_rows, [None] * t.num_rows
            for k, (a, b, s) in enumerate(walk(col["start"], col["end"], col["base_score"], col["is_final"], closed, col["_guarded"], cfg, lo, hi), 1):
                seg[a : b + 1] = [k] * (b - a + 1)
                score[a : b + 1] = [s] * (b - a + 1)
            yield from t.append_column("segment", pa.array(seg, pa.int32())).append_column("boundary_score", pa.array(score, pa.float64())).to_batches()

        now = None
        for b in batches:
            f, r = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            for i in range(1, len(f) + 1):
                if i == len(f) or f[i] != f[at] or r[i] != r[at]:
                    if now is not None and now != (f[at], r[at]):
                        yield from cut(pa.concat_tables(held))
                        held = []
                    now = (f[at], r[at])
                    held.append(pa.Table.from_batches([b.slice(at, i - at)]))
                    at = i
        if held:
            yield from cut(pa.concat_tables(held))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields) + ", segment int, boundary_score double"
    return src.mapInArrow(run, schema)


def boundary_scores(words: DataFrame, cfg: Segmentation = Segmentation(), spans: Spans = Spans()) -> DataFrame:
    """What was weighed where a segment began: one row per begin and possible end, up to the first overlong sentence end.

    ``words`` comes from :func:`segments`. (file_id, region, start_pos, end_pos,
    duration, score, is_valid, reasons, left_text, right_text, gap_after).
    """
    lo, hi = spans.min_sec, min(spans.max_sec, cfg.semantic_max_sec)
    src = words.select("file_id", "region", "pos", "segment", "start", "end", "is_final").repartition("file_id", "region").sortWithinPartitions("file_id", "region", "pos")

    def weighed(key: tuple, rows: list[tuple]) -> list[tuple]:
        out, before = [], None
        for i, (pos, seg, start, _, _) in enumerate(rows):
            if seg == before:
                continue
            before = seg
            for end_pos, _, _, end, final in rows[i:]:
                out.append((*key, pos, end_pos, end - start))
                if round(end - start, 3) > hi and final:
                    break
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, types = None, [], None

        def emit() -> Iterator[pa.RecordBatch]:
            out = weighed(now, held)
            for at in range(0, len(out), 50_000):
                cols = list(zip(*out[at : at + 50_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["file_id", "region", "start_pos", "end_pos", "d"])

        for b in batches:
            types = [*(b.schema.field(i).type for i in (0, 1)), pa.int32(), pa.int32(), pa.float64()]
            for f, r, *row in zip(*(c.to_pylist() for c in b.columns)):
                if now != (f, r):
                    if held:
                        yield from emit()
                    now, held = (f, r), []
                held.append(tuple(row))
        if held:
            yield from emit()

    pairs = src.mapInArrow(run, f"file_id string, region {src.schema['region'].dataType.simpleString()}, start_pos int, end_pos int, d double")
    at = words.select("file_id", "region", F.col("pos").alias("end_pos"), F.col("text").alias("left_text"), "right_text", "gap_after", "base_score", "is_final", "base_reasons", "protections", (F.col("is_final") | F.col("_last")).alias("closed"))
    p = pairs.join(at, ["file_id", "region", "end_pos"])
    d = F.col("d")
    preferred, extended, short = d.between(cfg.preferred_min_sec, cfg.preferred_max_sec), (d > cfg.preferred_max_sec) & (d <= hi), (d >= lo) & (d < cfg.preferred_min_sec)
    middle = (cfg.preferred_min_sec + cfg.preferred_max_sec) / 2
    length = F.when(preferred, 3.0 + F.greatest(F.lit(0.0), 2.0 - F.abs(d - middle) * 0.35)).when(extended, 1.0).when(short, -1.0).otherwise(0.0)
    too_short, too_long = (d < lo) & F.lit(not cfg.allow_short_clips), (d > hi) & ~F.col("is_final")
    more = F.array_compact(F.array(F.when(preferred, "preferred_duration").when(extended, "extended_duration").when(short, "short_duration"), F.when(too_short, "duration_too_short"), F.when(too_long, "duration_too_long")))
    valid = F.col("closed") & (F.size("protections") == 0) & ~too_short & ~too_long
    return p.select("file_id", "region", "start_pos", "end_pos", F.round(d, 3).alias("duration"), F.round(F.col("base_score") + length + 1e-9, 3).alias("score"), valid.alias("is_valid"), F.array_sort(F.array_distinct(F.concat("base_reasons", "protections", more))).alias("reasons"), "left_text", "right_text", F.round("gap_after", 3).alias("gap_after"))


def candidates(words: DataFrame, cfg: Segmentation = Segmentation(), spans: Spans = Spans()) -> DataFrame:
    """One row per segment: padded and raw times, text, words, mean log-probability, score and reasons of its boundary."""
    lo, hi = spans.min_sec, min(spans.max_sec, cfg.semantic_max_sec)
    # the mean of log-probabilities of four decimals, exact and rounded half up
    lp = F.sum(F.round(F.col("logprob") * 10000).cast("bigint"))
    g = words.groupBy("file_id", "region", "segment").agg(
        F.min_by("start", "pos").alias("raw_start"), F.max_by("end", "pos").alias("raw_end"), F.sort_array(F.collect_list(F.struct("pos", "text", "index"))).alias("w"),
        F.count_if(K.has_word(F.col("text"))).alias("word_count"), (F.floor((2 * lp + F.count("logprob")) / (2 * F.count("logprob"))) / 10000).alias("avg_logprob"), F.first("selected_speaker").alias("speaker_id"), F.first("boundary_score").alias("boundary_score"),
        F.max_by(F.struct("base_reasons", "protections", "is_final"), "pos").alias("at"),
    )
    d = F.col("raw_end") - F.col("raw_start")
    length = F.when((d >= cfg.preferred_min_sec) & (d <= cfg.preferred_max_sec), "preferred_duration").when((d > cfg.preferred_max_sec) & (d <= hi), "extended_duration").when((d >= lo) & (d < cfg.preferred_min_sec), "short_duration")
    start, end = F.greatest(F.lit(0.0), F.col("raw_start") - cfg.boundary_pad_sec), F.col("raw_end") + cfg.boundary_pad_sec
    found = F.col("boundary_score").isNotNull()
    return g.select(
        "file_id", "region", "segment", F.round(start, 3).alias("start"), F.round(end, 3).alias("end"), "raw_start", "raw_end", F.round(end - start, 3).alias("duration"),
        T.join_words(F.transform("w", lambda x: x["text"])).alias("text"), "speaker_id", "word_count", "avg_logprob", F.when(found, "stt_semantic").otherwise("stt_rejected_region").alias("source"),
        F.transform("w", lambda x: x["index"]).alias("word_indexes"), "boundary_score", F.when(found, F.array_sort(F.array_compact(F.concat("at.base_reasons", F.array(length))))).alias("boundary_reasons"),
    )


def neighbours(cands: DataFrame, tokens: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """(file_id, region, segment, audio_event_overlap, speaker_overlap, risky_leading, risky_trailing) by one interval join.

    The join is an equi-join on (file, size class, bucket of time): a token is in
    the buckets of its own class only, so one that lasts for days is two rows
    too; a candidate looks into its buckets of every class. Only tokens within
    ``boundary_guard_sec`` of a candidate can matter, which also bounds the
    search for its nearest neighbours.
    """
    g = cfg.boundary_guard_sec
    bucket = lambda x, w: F.floor(x / w) if w < float("inf") else F.lit(0).cast("bigint")
    c = cands.select("file_id", "region", "segment", "raw_start", "raw_end", F.col("speaker_id").alias("target"))
    of_class = lambda k: lambda x: F.struct(F.lit(k).alias("class"), x.alias("bucket"))
    own = [F.transform(F.sequence(bucket(F.col("raw_start") - g, w), bucket(F.col("raw_end") + g, w)), of_class(k)) for k, w in enumerate(BUCKETS_SEC)]
    c = c.select("*", F.inline(F.concat(*own)))
    t = tokens.select(F.col("file_id").alias("_f"), F.col("start").alias("a"), F.col("end").alias("b"), "index", K.is_event().alias("event"), K.is_speech().alias("speech"), K.speaker(cfg).alias("who"))
    kind_of = F.lit(0)
    for w in BUCKETS_SEC[:-1]:
        kind_of = kind_of + (F.col("b") - F.col("a") > w).cast("int")
    ends = F.lit(None).cast("array<bigint>")
    for k, w in enumerate(BUCKETS_SEC):
        ends = F.when(F.col("_c") == k, F.array_distinct(F.array(bucket(F.col("a"), w), bucket(F.col("b"), w)))).otherwise(ends)
    t = t.withColumn("_c", kind_of).withColumn("_b", F.explode(ends))
    j = c.join(t, (F.col("file_id") == F.col("_f")) & (F.col("class") == F.col("_c")) & (F.col("bucket") == F.col("_b")) & (F.col("a") <= F.col("raw_end") + g) & (F.col("b") >= F.col("raw_start") - g))
    other = F.col("speech") & ~F.col("who").eqNullSafe(F.col("target"))
    inside = (F.col("a") < F.col("raw_end")) & (F.col("b") > F.col("raw_start"))
    at = F.struct("a", "b", "index")
    risky = F.col("event") | other
    kind = F.when(F.col("who").isNull(), "unknown_speaker_overlap").otherwise("mixed_speaker_overlap")
    # a repeated token (in two buckets) changes no minimum or maximum
    return j.groupBy("file_id", "region", "segment").agg(
        F.max(inside & F.col("event")).alias("audio_event_overlap"),
        F.min_by(kind, F.when(inside & other, at)).alias("speaker_overlap"),
        F.max_by(risky & (F.col("raw_start") - F.col("b") < g), F.when(F.col("b") <= F.col("raw_start"), F.struct("b", -F.col("a"), -F.col("index")))).alias("risky_leading"),
        F.min_by(risky & (F.col("a") - F.col("raw_end") < g), F.when(F.col("a") >= F.col("raw_end"), at)).alias("risky_trailing"),
    )


def validate(cands: DataFrame, tokens: DataFrame, cfg: Segmentation = Segmentation(), spans: Spans = Spans()) -> DataFrame:
    """Candidates with ``reject_reasons`` in order of name; empty if the segment is safe."""
    lo, hi = spans.min_sec, min(spans.max_sec, cfg.semantic_max_sec)
    n = neighbours(cands.where("boundary_score IS NOT NULL"), tokens, cfg)
    c = cands.join(n, ["file_id", "region", "segment"], "left")
    d = F.col("end") - F.col("start")
    yes = lambda x: F.coalesce(x, F.lit(False))
    rules = [
        (yes(F.col("audio_event_overlap")), "audio_event_overlap"),
        (yes(F.col("avg_logprob") < cfg.min_avg_logprob) if cfg.min_avg_logprob is not None else F.lit(False), "avg_logprob_too_low"),
        ((d > hi) & ~F.array_contains("boundary_reasons", "sentence_punctuation"), "duration_too_long"),
        ((d < lo) & F.lit(not cfg.allow_short_clips), "duration_too_short"),
        (F.col("text") == "", "empty_text"),
        (yes(F.col("risky_leading")), "risky_leading_transition"),
        (yes(F.col("risky_trailing")), "risky_trailing_transition"),
        (F.col("word_count") < cfg.min_words, "word_count_too_low"),
    ]
    found = F.array_compact(F.array(*[F.when(c_, F.lit(n_)) for c_, n_ in rules], F.col("speaker_overlap")))
    reasons = F.when(F.col("boundary_score").isNull(), F.array(F.lit("no_safe_semantic_boundary"))).otherwise(F.array_sort(found))
    return c.withColumn("reject_reasons", reasons).drop("audio_event_overlap", "speaker_overlap", "risky_leading", "risky_trailing")


def build(tokens: DataFrame, target: DataFrame, cfg: Segmentation = Segmentation(), spans: Spans = Spans()) -> DataFrame:
    """Validated candidates of all files."""
    words = durable(segments(boundary_features(regions(tokens, target, cfg), cfg), cfg, spans), "segments")
    return validate(candidates(words, cfg, spans), tokens, cfg, spans)


def report(validated: DataFrame) -> DataFrame:
    """Per file: accepted and rejected candidates, accepted time, reasons with counts."""
    ok = F.size("reject_reasons") == 0
    base = validated.groupBy("file_id").agg(F.count_if(ok).alias("segment_count"), F.count_if(~ok).alias("rejected_count"), F.round(F.sum(F.when(ok, F.col("duration")).otherwise(0.0)), 3).alias("accepted_duration_seconds"))
    why = validated.select("file_id", F.explode("reject_reasons").alias("reason")).groupBy("file_id", "reason").agg(F.count(F.lit(1)).alias("n")).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("reject_reason_counts"))
    return base.join(why, "file_id", "left")
