"""Where models plug in: voice detection and recognition run inside Arrow batches, loaded once per worker, with retries and resuming."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from voxloom.operators import dataset
from voxloom.settings import Voice


class Transcriber(Protocol):
    """Recognises one clip: a mapping with text, language, avg_logprob, no_speech_prob."""

    def __call__(self, audio: bytes | str) -> dict[str, Any]: ...


class VoiceDetector(Protocol):
    """Spans of speech (start, end in seconds) in mono samples."""

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float]]: ...


class EnergyDetector:
    """A detector without a model: windows of 10 ms above a level, joined over short silence, padded."""

    def __init__(self, cfg: Voice = Voice(), level: float = 0.01) -> None:
        self.cfg, self.level = cfg, level

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float]]:
        w = max(1, rate // 100)
        n = len(samples) // w
        loud = np.sqrt((np.asarray(samples[: n * w], np.float64).reshape(n, w) ** 2).mean(1)) >= self.level if n else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], loud.astype(np.int8), [0]])))
        spans: list[list[int]] = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if spans and (a - spans[-1][1]) * 10 < self.cfg.min_silence_ms:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        pad, end = self.cfg.speech_pad_ms / 1000, len(samples) / rate
        return [(round(max(0.0, a / 100 - pad), 3), round(min(end, b / 100 + pad), 3)) for a, b in spans if (b - a) * 10 >= self.cfg.min_speech_ms]


class EchoTranscriber:
    """A stand-in that is the same everywhere: says the length of the clip."""

    def __call__(self, audio: bytes | str) -> dict[str, Any]:
        return {"text": f"clip {len(audio)}", "language": "vi", "avg_logprob": -0.1, "no_speech_prob": 0.0}


def backend_name(name: str | None, known: tuple[str, ...] = ("local", "remote")) -> str:
    """A backend's name in one spelling; an error for one that is not known."""
    x = (name or known[0]).strip().lower().replace("-", "_").replace(" ", "_")
    if x not in known:
        raise ValueError(f"unknown backend {name!r}")
    return x


def resolve_device(wanted: str, has_gpu: Callable[[], bool]) -> str:
    """'cuda' or 'cpu': 'auto', and 'cuda' where there is none, ask the machine the worker runs on."""
    wanted = (wanted or "auto").strip().lower()
    return ("cuda" if has_gpu() else "cpu") if wanted in ("auto", "cuda") else wanted


def resolve_compute_type(wanted: str, device: str) -> str:
    """Half precision is for accelerators: on a CPU it becomes int8."""
    return "int8" if device == "cpu" and (wanted or "").lower() in ("float16", "bfloat16") else wanted


def with_fallback(load: Callable[[str, str], Any], device: str, compute_type: str) -> Any:
    """load(device, compute type); if an accelerator fails, on the CPU."""
    try:
        return load(device, resolve_compute_type(compute_type, device))
    except Exception:
        if device == "cpu":
            raise
        return load("cpu", resolve_compute_type(compute_type, "cpu"))


def retried(f: Callable[[Any], Any], x: Any, waits: tuple[float, ...] = (1.0, 2.0)) -> Any:
    """f(x), tried again after each wait; the last error is raised."""
    for w in (*waits, None):
        try:
            return f(x)
        except Exception:
            if w is None:
                raise
            time.sleep(w)
    return None


def detect(clips: DataFrame, make: Callable[[], VoiceDetector], samples: str = "samples", rate: str = "sample_rate") -> DataFrame:
    """(file_id, start, end, duration): the spans of every recording, in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            rows = [(f, s, e, round(e - s, 3)) for f, x, r in zip(b["file_id"], b["samples"], b["rate"]) if x is not None for s, e in model(np.asarray(x), int(r)) if e > s]
            yield pd.DataFrame(rows, columns=["file_id", "start", "end", "duration"])

    src = clips.select("file_id", F.col(samples).alias("samples"), F.col(rate).alias("rate"))
    return src.mapInPandas(run, "file_id string, start double, end double, duration double")


_OUT = "id string, audio_path string, duration double, text string, language string, avg_logprob double, no_speech_prob double, error string"


def transcribe(manifest: DataFrame, make: Callable[[], Transcriber], previous: DataFrame | None = None, waits: tuple[float, ...] = (1.0, 2.0)) -> DataFrame:
    """Transcripts of all clips; those that an earlier run completed are taken over, not recognised again.

    An error of one clip is recorded in its row (empty text) and never fails
    the job. ``manifest`` (id, audio_path, duration[, content]).
    """
    m = manifest if "content" in manifest.columns else manifest.withColumn("content", F.lit(None).cast("binary"))
    m = dataset.resume(m, previous) if previous is not None else m.withColumn("reused", F.lit(False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for b in batches:
            out = []
            for i, p, d, c in zip(b["id"], b["audio_path"], b["duration"], b["content"]):
                try:
                    model = model or make()
                    r = retried(model, c if c is not None else p, waits)
                    out.append((i, p, d, r["text"], r.get("language"), r.get("avg_logprob"), r.get("no_speech_prob"), None))
                except Exception as e:  # noqa: BLE001
                    out.append((i, p, d, "", None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in _OUT.split(", ")])

    todo = m.where("NOT reused").select("id", "audio_path", "duration", "content").mapInPandas(run, _OUT)
    if previous is None:
        return todo
    return m.where("reused").select("id", "audio_path", "duration", "text", "language", "avg_logprob", "no_speech_prob", F.lit(None).cast("string").alias("error")).unionByName(todo)
