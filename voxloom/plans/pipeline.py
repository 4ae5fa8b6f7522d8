"""The stages of dataset building as functions from tables to tables, and their writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from voxloom.operators import dataset, gate, segmentation, signal, spans, tokens
from voxloom.runtime import durable
from voxloom.settings import Settings
from voxloom.sources import files


@dataclass(frozen=True)
class Segmented:
    tokens: DataFrame
    inspection: DataFrame
    stats: DataFrame
    target: DataFrame
    candidates: DataFrame


def inspect(raw_words: DataFrame, cfg: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokens, inspection, speaker statistics) of all recordings."""
    t, counts = tokens.normalise(raw_words)
    t = durable(t, "tokens")
    return t, tokens.inspection(t, counts, cfg.stt_segmentation), tokens.speaker_stats(t, cfg.stt_segmentation)


def segment_words(raw_words: DataFrame, cfg: Settings = Settings()) -> Segmented:
    """Transcript first: target speakers and validated segments of all recordings."""
    s = cfg.stt_segmentation
    t, seen, stats = inspect(raw_words, cfg)
    stats = durable(stats, "speaker-stats")
    target = tokens.select_target(stats, s, seen)
    return Segmented(t, seen, stats, target, segmentation.build(t, target, s, cfg.segments))


def segment_spans(vad: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Voice activity first: numbered segments of all recordings."""
    return spans.build(spans.valid_spans(vad), cfg.segments)


def choose(labelled: DataFrame, include_review: bool = False) -> DataFrame:
    """Good clips, with ``include_review`` also those to be looked at, then in order of start and id."""
    good = labelled.where("quality_label = 'good'")
    return good.unionByName(labelled.where("quality_label = 'review'")).orderBy("start", "id") if include_review else good


def judge(transcripts: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return gate.decisions(gate.cleaned(transcripts, cfg.cleaning), cfg.filter)


def export(accepted: DataFrame, folder: str) -> dict:
    """Writes metadata lines, the manifest and the summary; all must have the same number of records."""
    a = durable(dataset.check_accepted(accepted), "accepted")
    n = files.write_lines(dataset.metadata_lines(a), f"{folder}/metadata.csv")
    m = files.write_lines(dataset.manifest_lines(a, folder), f"{folder}/manifest.jsonl")
    s = files.write_report(dataset.summary(a), f"{folder}/summary.json")
    if not n == m == s["total_accepted"]:
        raise ValueError(f"records differ: {n} metadata lines, {m} manifest lines, {s['total_accepted']} accepted")
    return s


def skip_done(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """Recordings without a complete result."""
    return inputs.join(done.select("file_id").distinct(), "file_id", "left_anti")


def batch_totals(results: DataFrame) -> DataFrame:
    """One row: recordings by status, and the time exported."""
    one = lambda s: F.count_if(F.col("status") == s).alias(s)
    return results.agg(F.count(F.lit(1)).alias("total"), one("succeeded"), one("failed"), one("skipped"), F.round(F.sum(F.coalesce("duration_seconds", F.lit(0.0))), 3).alias("duration_seconds"))


def label_clips(clips: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return signal.labels(signal.measure(clips, cfg=cfg.audio_quality), cfg.audio_quality)


def route_quality(labelled: DataFrame, folder: str) -> dict[str, int]:
    """Good, bad and clips for review as three manifests, and the counts of labels and reasons beside them."""
    n = files.write_routes(labelled, "quality_label", ("good", "bad", "review"), folder)
    files.write_jsonl(signal.label_report(labelled), f"{folder}/labels.jsonl")
    files.write_jsonl(gate.histogram(labelled, "quality_reasons"), f"{folder}/reasons.jsonl")
    return n


def route_decisions(decided: DataFrame, folder: str) -> dict:
    """Accepted and rejected records as two files, and the report."""
    n = files.write_routes(decided.withColumn("route", F.when(F.col("accepted"), "accepted").otherwise("rejected")), "route", ("accepted", "rejected"), folder)
    r = files.write_report(gate.report(decided), f"{folder}/report.json")
    if (n["accepted"], n["rejected"]) != (r["accepted_count"], r["rejected_count"]):
        raise ValueError("the files and the report differ")
    return r


def inspection_totals(results: DataFrame) -> DataFrame:
    """One row: recordings inspected, succeeded and failed."""
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"))


def run_recordings(words: DataFrame, audio: DataFrame, folder: str, cfg: Settings = Settings()) -> dict:
    """From the words and the WAV of recordings to a dataset: segments, clips, quality, gate, export.

    ``words`` as for :func:`segment_words`, ``audio`` (file_id, content). Clips
    are named <recording>_<number in order of start>; those of good quality
    whose text passes the gate are exported with metadata, manifest and summary.
    """
    found = segment_words(words, cfg).candidates.where("size(reject_reasons) = 0")
    numbered = spans.numbered(found.select("file_id", "start", "end", "text", "speaker_id", "avg_logprob"))
    seg = durable(numbered.withColumn("id", F.concat_ws("_", files.safe_id(F.col("file_id")), "no")), "segments-of-words")
    cuts = files.cut_wavs(audio, seg.select("file_id", "id", "start", "end")).join(seg.select("id", "start", "end", "text", "speaker_id", "avg_logprob"), "id")
    cuts = durable(files.check_cuts(cuts.withColumn("expected", F.col("end") - F.col("start"))), "cuts")
    cuts = cuts.withColumns({"samples": files.wav_samples("content"), "sample_rate": files.wav_header("content")["rate"], "audio_path": F.concat(F.lit(f"{folder}/wavs/"), "id", F.lit(".wav"))})
    labelled = durable(label_clips(cuts, cfg).drop("samples"), "labelled")
    route_quality(labelled.drop("content"), f"{folder}/quality")
    decided = durable(judge(choose(labelled).drop("content"), cfg), "decided")
    route_decisions(decided, f"{folder}/gate")
    return export(decided.where("accepted"), folder)
