"""Cleaning transcripts and accepting or rejecting them with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxloom.functions import text as T
from voxloom.settings import Cleaning, Gate


def cleaned(df: DataFrame, cfg: Cleaning = Cleaning(), text: str = "text") -> DataFrame:
    """Adds cleaned_text, is_empty_after_cleaning and cleaning_changed_text; a null text counts as empty."""
    # a generator is evaluated once a row: the many uses of the cleaned text do not repeat the cleaning
    df = df.select("*", F.inline(F.array(F.struct(T.clean(F.col(text), cfg).alias("cleaned_text")))))
    return df.withColumns(
        {"is_empty_after_cleaning": F.col("cleaned_text") == "", "cleaning_changed_text": F.col("cleaned_text") != F.coalesce(F.col(text), F.lit(""))}
    )


def cleaning_counts(df: DataFrame) -> DataFrame:
    """One row: rows read, rows that cleaning changed, rows left empty."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("cleaning_changed_text").alias("changed_rows"), F.count_if("is_empty_after_cleaning").alias("empty_rows"))


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The names whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def decisions(df: DataFrame, cfg: Gate = Gate(), has_audio: Column | None = None, rms: Column | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """One decision per cleaned transcript: text reasons, then audio reasons, accepted if there is none.

    Wants id, audio_path, duration, cleaned_text; avg_logprob, no_speech_prob
    and is_empty_after_cleaning are used where present. ``has_audio`` tells
    whether the clip exists (unknown counts as existing), ``rms`` its loudness.
    """
    have = set(df.columns)
    optional = lambda name, kind: F.col(name) if name in have else F.lit(None).cast(kind)
    t = F.coalesce(F.col("cleaned_text"), F.lit(""))
    logprob, no_speech = T.finite(optional("avg_logprob", "double")), T.finite(optional("no_speech_prob", "double"))
    duration = T.finite(F.col("duration"))
    once = F.struct(T.word_count(t).alias("_words"), (F.lit(None).cast("double") if cfg.max_unusual_symbol_ratio is None else T.unusual_symbol_ratio(t)).alias("_odd"))
    df = df.select("*", F.inline(F.array(once)))
    words = F.col("_words")
    say = [(t == "", "empty_cleaned_text"), (F.coalesce(optional("is_empty_after_cleaning", "boolean"), F.lit(False)), "marked_empty_after_cleaning"), (words < cfg.min_words, "word_count_too_low")]
    if cfg.max_unusual_symbol_ratio is not None:
        say.append(((t != "") & (F.col("_odd") > cfg.max_unusual_symbol_ratio), "too_many_unusual_symbols"))
    if cfg.min_avg_logprob is not None:
        say.append((logprob < cfg.min_avg_logprob, "avg_logprob_too_low"))
    if cfg.max_no_speech_prob is not None:
        say.append((no_speech > cfg.max_no_speech_prob, "no_speech_prob_too_high"))
    say += [(duration.isNull(), "missing_duration"), (duration < cfg.min_sec, "duration_too_short"), (duration > cfg.max_sec, "duration_too_long")]
    if has_audio is not None:
        say.append((~has_audio, "audio_missing"))
    if cfg.min_rms is not None and rms is not None:
        say += [(rms.isNull(), "audio_analysis_failed"), (rms < cfg.min_rms, "audio_rms_too_low")]
    d = df.select(F.coalesce("id", F.lit("")).alias("id"), t.alias("cleaned_text"), F.coalesce("audio_path", F.lit("")).alias("audio_path"), duration.alias("duration"), reasons(*say).alias("reject_reasons"), words.alias("word_count"), F.length(t).alias("char_count"), *extra)
    return d.withColumn("accepted", F.size("reject_reasons") == 0)


def histogram(df: DataFrame, reasons_col: str = "reject_reasons") -> DataFrame:
    """(reason, n): how often each reason occurs."""
    return df.select(F.explode(reasons_col).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def report(d: DataFrame) -> DataFrame:
    """One row: rows, accepted, rejected, and the reasons with their counts in order of reason."""
    counts = d.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("accepted").alias("accepted_count"), F.count_if(~F.col("accepted")).alias("rejected_count"))
    reasons_ = histogram(d).agg(F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("reject_reason_counts"))
    return counts.join(F.broadcast(reasons_))  # two aggregates of one row each
