"""Timestamped words: validation, kinds of token, and runs of tokens in order of time.

Runs are numbered without gathering a recording: each time shard is ordered on
its own, and what a shard needs from earlier ones (its predecessor token, the
number of runs begun before) comes from one summary row per shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voxloom.functions import text as T
from voxloom.settings import Segmentation

SHARD_SEC = 600.0
ORDER = ("start", "end", "index")


def normalise(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid tokens, counts per file_id of rows read and rows invalid).

    The text of a token is ``text``, or if that is null or empty ``word``, where
    there is such a column. A token is valid if its text is not blank and its times are finite with
    end > start; copies of a row count once; times are rounded to milliseconds.
    """
    said = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("word") if "word" in raw.columns else F.lit(None), F.lit(""))
    r = raw.select("file_id", "index", T.strip(said).alias("text"), "start", "end", F.coalesce("type", F.lit("word")).alias("type"), "speaker_id", T.finite(F.col("logprob")).alias("logprob")).distinct()
    ok = (F.col("text") != "") & (F.abs("start") < float("inf")) & ~F.isnan("start") & (F.abs("end") < float("inf")) & ~F.isnan("end") & (F.col("end") > F.col("start"))
    r = r.withColumn("ok", F.coalesce(ok, F.lit(False)))
    counts = r.groupBy("file_id").agg(F.count(F.lit(1)).alias("tokens"), F.count_if(~F.col("ok")).alias("invalid"))
    valid = r.where("ok").drop("ok").withColumns({"start": F.round("start", 3), "end": F.round("end", 3)})
    return valid.withColumn("duration", F.round(F.col("end") - F.col("start"), 3)), counts


def is_event(text: str = "text", type_: str = "type") -> Column:
    return F.lower(F.coalesce(type_, F.lit(""))).contains("event") | F.col(text).rlike(r"^\s*[\[(<].+[\])>]\s*$")


def is_speech(text: str = "text", type_: str = "type") -> Column:
    return ~is_event(text, type_) & ~F.lower(F.coalesce(type_, F.lit("word"))).isin("spacing", "space") & (F.col(text) != "")


def has_word(text: Column) -> Column:
    return text.rlike(r"[\p{L}\p{N}_]")


def speaker(cfg: Segmentation) -> Column:
    """The token's speaker; null if unknown; always speaker_0 without diarisation."""
    return F.nullif(F.col("speaker_id"), F.lit("")) if cfg.diarize else F.lit("speaker_0")


def runs(tokens: DataFrame, keep: Column, who: Column, max_gap: float, shard_sec: float = SHARD_SEC) -> DataFrame:
    """The tokens for which ``keep`` holds, with ``run``: equal for neighbours of one ``who`` that follow each other within ``max_gap``.

    Any other token between two kept ones ends a run. Runs are numbered from 1
    in each file in order of time.
    """
    t = tokens.withColumns({"_shard": F.floor(F.col("start") / shard_sec), "_keep": F.coalesce(keep & who.isNotNull(), F.lit(False)), "_who": who})
    by = W.partitionBy("file_id", "_shard").orderBy(*ORDER)
    at = F.struct(*ORDER)

    def begins(before: str, here: str = "") -> Column:
        """1 if the token begins a run, given the one before it."""
        gap = F.greatest(F.lit(0.0), F.col(f"{here}start") - F.col(f"{before}._end"))
        goes_on = F.coalesce(F.col(f"{before}._keep") & (F.col(f"{before}._who") == F.col(f"{here}_who")) & (gap <= max_gap), F.lit(False))
        return F.when(F.col(f"{here}_keep") & ~goes_on, 1).otherwise(0)

    t = t.withColumn("_before", F.lag(F.struct("_keep", "_who", F.col("end").alias("_end"))).over(by))
    # the first token of a shard has its predecessor in an earlier one: that is settled on the summaries
    t = t.withColumn("_new", F.when(F.col("_before").isNull(), 0).otherwise(begins("_before")))
    per = t.groupBy("file_id", "_shard").agg(
        F.min_by(F.struct("_keep", "_who", "start"), at).alias("_first"), F.max_by(F.struct("_keep", "_who", F.col("end").alias("_end")), at).alias("_last"), F.sum("_new").alias("_n")
    )
    order = W.partitionBy("file_id").orderBy("_shard")
    per = per.withColumn("_carry", F.lag("_last").over(order)).withColumn("_head", begins("_carry", "_first."))
    per = per.withColumn("_off", F.coalesce(F.sum(F.col("_n") + F.col("_head")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("_head"))
    p = per.select(F.col("file_id").alias("_f"), F.col("_shard").alias("_s"), "_off")
    t = t.withColumn("run", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    t = t.join(p, t.file_id.eqNullSafe(p._f) & t._shard.eqNullSafe(p._s), "left").withColumn("run", F.col("run") + F.col("_off"))
    return t.where("_keep").drop("_shard", "_keep", "_who", "_before", "_new", "_off", "_f", "_s")


def turns(tokens: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """Speaker turns: (file_id, speaker_id, turn, start, end, duration, word_count, text, word_indexes)."""
    t = runs(tokens.withColumn("who", speaker(cfg)), is_speech(), F.col("who"), cfg.max_word_gap_sec)
    words = F.sort_array(F.collect_list(F.struct(*ORDER, "text")))
    g = t.groupBy("file_id", F.col("run").alias("turn")).agg(F.first("who").alias("speaker_id"), F.min("start").alias("start"), F.max_by("end", F.struct(*ORDER)).alias("end"), F.count_if(has_word(F.col("text"))).alias("word_count"), words.alias("w"))
    return g.select("file_id", "speaker_id", "turn", "start", "end", F.round(F.col("end") - F.col("start"), 3).alias("duration"), "word_count", T.join_words(F.transform("w", lambda x: x["text"])).alias("text"), F.transform("w", lambda x: x["index"]).alias("word_indexes"))


def speaker_stats(tokens: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """Per file and speaker: time, share of the speech, words, turns, mean turn length, first start, last end, up to three sample utterances."""
    ms = F.round((F.col("end") - F.col("start")) * 1000).cast("bigint")
    base = tokens.where(is_speech()).withColumn("speaker_id", speaker(cfg)).where("speaker_id IS NOT NULL").groupBy("file_id", "speaker_id").agg(F.sum(ms).alias("ms"), F.count(F.lit(1)).alias("word_count"), F.min("start").alias("first_start"), F.max("end").alias("last_end"))
    t = turns(tokens, cfg)
    three = F.slice(F.sort_array(F.collect_list(F.when(F.col("turn_of_speaker") <= 3, F.struct("turn", "text")))), 1, 3)
    ranked = t.withColumn("turn_of_speaker", F.row_number().over(W.partitionBy("file_id", "speaker_id").orderBy("turn")))
    per = ranked.groupBy("file_id", "speaker_id").agg(F.count(F.lit(1)).alias("turn_count"), F.sum(F.round(F.col("duration") * 1000).cast("bigint")).alias("turn_ms"), three.alias("s"))
    s = base.join(per, ["file_id", "speaker_id"], "left")
    total = F.sum("ms").over(W.partitionBy("file_id"))
    return s.select("file_id", "speaker_id", (F.col("ms") / 1000).alias("duration_seconds"), F.round(F.col("ms") / F.greatest(total, F.lit(1)), 4).alias("share"), "word_count", F.coalesce("turn_count", F.lit(0)).alias("turn_count"), F.coalesce(F.floor((2 * F.col("turn_ms") + F.col("turn_count")) / (2 * F.col("turn_count"))) / 1000, F.lit(0.0)).alias("average_turn_duration_seconds"), "first_start", "last_end", F.filter(F.transform("s", lambda x: x["text"]), lambda x: x != "").alias("sample_utterances"))


def inspection(tokens: DataFrame, counts: DataFrame, cfg: Segmentation = Segmentation()) -> DataFrame:
    """One row per file: tokens, invalid rows, speakers, words without a speaker, audio events."""
    lost = is_speech() & speaker(cfg).isNull()
    t = tokens.groupBy("file_id").agg(F.count(F.lit(1)).alias("total_timestamped_tokens"), F.count_if(lost).alias("missing_speaker_word_count"), F.count_if(is_event()).alias("audio_event_count"), F.count_distinct(F.when(is_speech(), speaker(cfg))).alias("speaker_count"))
    return counts.join(t, "file_id", "left").select("file_id", F.coalesce("total_timestamped_tokens", F.lit(0)).alias("total_timestamped_tokens"), F.col("invalid").alias("invalid_word_count"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("speaker_count", "missing_speaker_word_count", "audio_event_count")])


def stem_of(path: str) -> str:
    """The file name of a path without its last suffix."""
    name = path.replace("\\", "/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] else name


def select_target(stats: DataFrame, cfg: Segmentation = Segmentation(), missing: DataFrame | None = None) -> DataFrame:
    """(file_id, selected_speaker, selection_source, share, selection_warnings), one row per file.

    A configured speaker (per file, else the default, else the older key) comes
    first and must exist; otherwise the one who speaks longest, then says most
    words, then is first by name. In manual mode a missing choice is an error.
    """
    mode = cfg.speaker_selection_mode.strip().lower()
    if mode not in ("auto", "auto_with_warning", "manual"):
        raise ValueError(f"unknown speaker_selection_mode {cfg.speaker_selection_mode!r}")
    default = next((x for x in (cfg.default_target_speaker, cfg.dominant_speaker) if x and x != "auto"), None)
    name = F.regexp_extract("file_id", r"([^/\\]*)$", 1)
    spellings = [F.col("file_id"), F.translate("file_id", "\\", "/"), name, F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")]
    chosen = F.lit(None).cast("string")
    if cfg.per_file_target_speakers:
        m = F.create_map(*[F.lit(x) for kv in cfg.per_file_target_speakers.items() for x in kv])
        stem = F.create_map(*[F.lit(x) for k, v in cfg.per_file_target_speakers.items() for x in (stem_of(k), v)])
        chosen = F.coalesce(*[F.element_at(m, k) for k in spellings], F.element_at(stem, spellings[-1]))
    wanted = F.coalesce(chosen, F.lit(default))
    by = W.partitionBy("file_id")
    s = stats.withColumn("wanted", wanted)
    rank = F.row_number().over(by.orderBy(F.col("duration_seconds").desc(), F.col("word_count").desc(), "speaker_id"))
    s = s.withColumn("rank", rank).withColumns({"pick": F.when(F.col("wanted").isNotNull(), F.col("speaker_id") == F.col("wanted")).otherwise(F.col("rank") == 1), "source": F.when(chosen.isNotNull(), "per_file").when(F.col("wanted").isNotNull(), "default").otherwise("auto")})
    s = s.withColumns({"picked": F.max("pick").over(by), "best_other": F.max(F.when(~F.col("pick"), F.col("share"))).over(by)})
    problem = F.when(~F.col("picked"), F.concat(F.lit("configured target speaker was not found in "), "file_id"))
    if mode == "manual" or cfg.require_manual_speaker:
        problem = F.coalesce(problem, F.when(F.col("wanted").isNull(), F.concat(F.lit("no target speaker is configured for "), "file_id")))
    s = s.withColumn("share", F.when(problem.isNotNull(), F.raise_error(problem).cast("double")).otherwise(F.col("share"))).where(F.col("pick") | (~F.col("picked") & (F.col("rank") == 1)))
    lost = F.lit(False)
    if missing is not None:
        m = missing.select(F.col("file_id").alias("_f"), F.col("missing_speaker_word_count").alias("_m"))
        s = s.join(m, s.file_id == m._f, "left").drop("_f")
        lost = F.coalesce(F.col("_m") > 0, F.lit(False))
    warn = F.array_compact(F.array(F.when(F.round(F.col("share") - F.col("best_other"), 10) <= 0.10, F.lit("close_second_speaker")), F.when(F.col("share") < cfg.min_speaker_share, F.lit("low_speaker_share")), F.when(lost, F.lit("missing_speaker_words"))))
    return s.select("file_id", F.col("speaker_id").alias("selected_speaker"), F.col("source").alias("selection_source"), "share", warn.alias("selection_warnings"))
