"""Signal measures of clips, quality labels and their reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxloom.operators.gate import reasons
from voxloom.settings import Signal

METRICS = ("rms_dbfs", "peak_dbfs", "clipping_ratio", "silence_ratio", "leading_silence_sec", "trailing_silence_sec", "spectral_flatness", "high_freq_energy_ratio")
CLIP_LEVEL = 0.999
HIGH_HZ = 5000.0
SPECTRUM_SEC = 2


def dbfs(level: Column) -> Column:
    return 20 * F.log10(F.greatest(level, F.lit(1e-12)))


def level_metrics(samples: Column, rate: Column, cfg: Signal = Signal()) -> dict[str, Column]:
    """Loudness, clipping and silence of a mono array of samples in [-1, 1], without leaving the JVM."""
    floor = float(10 ** (cfg.silence_threshold_dbfs / 20))
    n = F.size(samples)
    a = F.transform(samples, lambda x: F.abs(x.cast("double")))
    voiced = F.transform(a, lambda x: x >= floor)
    lead = lambda v: F.when(F.array_position(v, True) == 0, n).otherwise(F.array_position(v, True) - 1)
    square = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return {
        "rms_dbfs": dbfs(F.sqrt(square / n)),
        "peak_dbfs": dbfs(F.array_max(a)),
        "clipping_ratio": F.size(F.filter(a, lambda x: x >= CLIP_LEVEL)) / n,
        "silence_ratio": 1 - F.size(F.filter(voiced, lambda v: v)) / n,
        "leading_silence_sec": lead(voiced) / rate,
        "trailing_silence_sec": lead(F.reverse(voiced)) / rate,
    }


@F.pandas_udf(StructType([StructField("spectral_flatness", DoubleType()), StructField("high_freq_energy_ratio", DoubleType())]))
def spectrum(samples: pd.Series, rate: pd.Series) -> pd.DataFrame:
    """Flatness and share of magnitude from 5 kHz on, over the first two seconds under a Hann window; zeros below 16 samples."""
    out = np.zeros((len(samples), 2))
    for i, (s, r) in enumerate(zip(samples, rate)):
        x = np.asarray(s, np.float64)[: int(SPECTRUM_SEC * r)]
        if len(x) < 16:
            continue
        m = np.abs(np.fft.rfft(x * np.hanning(len(x)))) + 1e-12
        out[i] = np.exp(np.mean(np.log(m))) / np.mean(m), m[np.fft.rfftfreq(len(x), 1 / r) >= HIGH_HZ].sum() / m.sum()
    return pd.DataFrame(out, columns=["spectral_flatness", "high_freq_energy_ratio"])


def measure(df: DataFrame, samples: str = "samples", rate: str = "sample_rate", cfg: Signal = Signal()) -> DataFrame:
    """Adds the eight METRICS. A null or empty array has null metrics and error 'empty audio'."""
    ok = F.size(F.coalesce(F.col(samples), F.array().cast("array<float>"))) > 0
    df = df.withColumn("_sp", spectrum(F.coalesce(F.col(samples).cast("array<float>"), F.array().cast("array<float>")), F.col(rate)))
    lv = level_metrics(F.col(samples), F.col(rate), cfg)
    return df.withColumns({k: F.when(ok, v) for k, v in lv.items()} | {k: F.when(ok, F.col(f"_sp.{k}")) for k in METRICS[6:]} | {"error": F.when(~ok, "empty audio")}).drop("_sp")


def labels(df: DataFrame, cfg: Signal = Signal(), duration: Column | None = None) -> DataFrame:
    """Adds quality_label (good, review, bad) and quality_reasons: the bad reasons, or if there is none the review reasons.

    A clip without metrics (error, or a null or NaN one) is bad with reason
    'audio_analysis_failed' besides its duration reasons. A null duration is too short.
    """
    d = duration if duration is not None else F.col("duration")
    d = F.coalesce(d, F.lit(0.0))
    m = {k: F.col(k) for k in METRICS}
    known = F.lit(True)
    for k in METRICS:
        known = known & m[k].isNotNull() & ~F.isnan(m[k])
    bad = [(d < cfg.min_sec, "duration_too_short"), (d > cfg.max_sec, "duration_too_long")]
    look = [(known & (m["rms_dbfs"] < cfg.min_rms_dbfs), "audio_too_quiet"), (known & (m["rms_dbfs"] >= cfg.min_rms_dbfs) & (m["rms_dbfs"] < cfg.review_min_rms_dbfs), "audio_quiet_review")]
    # Metric, limits, reason if bad, reason if to be looked at.
    table = (
        ("clipping_ratio", cfg.max_clipping_ratio, cfg.review_clipping_ratio, "possible_clipping", "possible_clipping_review"),
        ("silence_ratio", cfg.max_silence_ratio, cfg.review_silence_ratio, "excessive_internal_silence", "internal_silence_review"),
        ("leading_silence_sec", cfg.max_leading_silence_sec, cfg.review_leading_silence_sec, "leading_silence_too_long", "leading_silence_review"),
        ("trailing_silence_sec", cfg.max_trailing_silence_sec, cfg.review_trailing_silence_sec, "trailing_silence_too_long", "trailing_silence_review"),
        ("spectral_flatness", cfg.max_spectral_flatness, cfg.review_spectral_flatness, "noise_or_reverb_proxy", "noise_or_reverb_review"),
        ("high_freq_energy_ratio", cfg.max_high_freq_energy_ratio, cfg.review_high_freq_energy_ratio, "high_frequency_noise_proxy", "high_frequency_noise_review"),
    )
    for k, most, review, why_bad, why_look in table:
        bad.append((known & (m[k] > most), why_bad))
        look.append((known & (m[k] > review) & (m[k] <= most), why_look))
    bad.append((~known, "audio_analysis_failed"))
    df = df.withColumns({"_bad": reasons(*bad), "_look": reasons(*look)})
    label = F.when(F.size("_bad") > 0, "bad").when(F.size("_look") > 0, "review").otherwise("good")
    return df.withColumns({"quality_label": label, "quality_reasons": F.when(F.size("_bad") > 0, F.col("_bad")).otherwise(F.col("_look"))}).drop("_bad", "_look")


def label_report(df: DataFrame) -> DataFrame:
    """(quality_label, n, duration_seconds)."""
    return df.groupBy("quality_label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round(F.coalesce("duration", F.lit(0.0)) * 1000).cast("bigint")) / 1000, 3).alias("duration_seconds"))


def nearest_rank(df: DataFrame, keys: list[str], value: str, q: tuple[float, ...]) -> DataFrame:
    """(keys..., n, q, value): exact nearest-index quantiles, index round-half-even((n - 1) q), null and NaN left out.

    Distributed also for one huge group: equal values are counted first, and
    positions come from running counts over the distinct values only.
    """
    from pyspark.sql import Window as W

    counts = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("k"))
    by = W.partitionBy(*keys)
    run = counts.withColumns({"upto": F.sum("k").over(by.orderBy("value").rowsBetween(W.unboundedPreceding, 0)), "n": F.sum("k").over(by)})
    wanted = F.explode(F.array(*[F.lit(x) for x in q])).alias("q")
    at = F.bround((F.col("n") - 1) * F.col("q"))
    return run.select(*keys, "value", "upto", "k", "n", wanted).where((at < F.col("upto")) & (at >= F.col("upto") - F.col("k"))).select(*keys, "n", "q", "value")


def metric_summary(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, min, avg, p50, p90, p95, max) over the rows that have the metric, six decimals."""
    long = df.unpivot([], metrics, "metric", "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    base = long.groupBy("metric").agg(F.round(F.min("value"), 6).alias("min"), F.round(F.sum(F.round(F.col("value") * 1_000_000).cast("decimal(38,0)")).cast("double") / F.count("value") / 1e6, 6).alias("avg"), F.round(F.max("value"), 6).alias("max"))
    pct = nearest_rank(long, ["metric"], "value", (0.5, 0.9, 0.95)).groupBy("metric").agg(*[F.round(F.max(F.when(F.col("q") == x, F.col("value"))), 6).alias(n) for x, n in ((0.5, "p50"), (0.9, "p90"), (0.95, "p95"))])
    return base.join(pct, "metric").select("metric", "min", "avg", "p50", "p90", "p95", "max")
