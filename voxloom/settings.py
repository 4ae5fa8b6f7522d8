"""Settings of the core operators: one frozen group per concern, loaded from a YAML file or a mapping.

Fixed values: the defaults below are those the results are defined by.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any


@dataclass(frozen=True)
class Spans:
    """Building segments from voice-activity spans (seconds)."""

    min_sec: float = 3.0
    max_sec: float = 15.0
    ideal_min: float = 4.5
    ideal_max: float = 8.0
    merge_gap_sec: float = 0.5
    force_split_target_sec: float = 8.0

    def __post_init__(self) -> None:
        if not 0 < self.min_sec <= self.ideal_min <= self.ideal_max <= self.max_sec:
            raise ValueError("segments: 0 < min_sec <= ideal_min <= ideal_max <= max_sec does not hold")
        if self.merge_gap_sec < 0 or self.force_split_target_sec <= 0:
            raise ValueError("segments: merge_gap_sec must not be negative, force_split_target_sec must be positive")


@dataclass(frozen=True)
class Cleaning:
    lowercase_text: bool = False
    remove_emojis: bool = True
    strip_quotes: bool = False


@dataclass(frozen=True)
class Signal:
    """Limits of signal quality: beyond ``max_*`` a clip is bad, beyond ``review_*`` it is to be looked at."""

    min_sec: float = 3.0
    max_sec: float = 10.0
    silence_threshold_dbfs: float = -55.0
    min_rms_dbfs: float = -28.0
    review_min_rms_dbfs: float = -24.0
    max_silence_ratio: float = 0.35
    review_silence_ratio: float = 0.20
    max_leading_silence_sec: float = 0.35
    review_leading_silence_sec: float = 0.15
    max_trailing_silence_sec: float = 0.35
    review_trailing_silence_sec: float = 0.15
    max_clipping_ratio: float = 0.01
    review_clipping_ratio: float = 0.002
    max_spectral_flatness: float = 0.20
    review_spectral_flatness: float = 0.10
    max_high_freq_energy_ratio: float = 0.30
    review_high_freq_energy_ratio: float = 0.18


@dataclass(frozen=True)
class Segmentation:
    """Speakers and sentence-like segments of a word stream."""

    diarize: bool = True
    dominant_speaker: str = "auto"
    speaker_selection_mode: str = "auto"
    default_target_speaker: str = "auto"
    require_manual_speaker: bool = False
    per_file_target_speakers: Mapping[str, str] = field(default_factory=dict)
    min_speaker_share: float = 0.45
    boundary_pad_sec: float = 0.05
    boundary_guard_sec: float = 0.20
    max_word_gap_sec: float = 0.80
    preferred_min_sec: float = 5.0
    preferred_max_sec: float = 10.0
    semantic_max_sec: float = 15.0
    sentence_punctuation_weight: float = 8.0
    clause_punctuation_weight: float = 4.0
    pause_strong_sec: float = 0.45
    pause_medium_sec: float = 0.25
    pause_strong_weight: float = 5.0
    pause_medium_weight: float = 2.5
    min_boundary_score: float = 7.0
    allow_short_clips: bool = False
    protect_named_entities: bool = True
    protect_connector_phrases: bool = True
    min_words: int = 3
    min_avg_logprob: float | None = None


@dataclass(frozen=True)
class Gate:
    """Accepting transcripts."""

    min_sec: float = 3.0
    max_sec: float = 15.0
    min_words: int = 3
    max_chars: int = 180  # reported only
    min_rms: float | None = None
    max_no_speech_prob: float | None = None
    min_avg_logprob: float | None = None
    max_unusual_symbol_ratio: float | None = 0.2


@dataclass(frozen=True)
class Voice:
    sampling_rate: int = 16000
    min_silence_ms: int = 250
    speech_pad_ms: int = 100
    min_speech_ms: int = 250
    threshold: float = 0.5


@dataclass(frozen=True)
class Recogniser:
    model_size: str = "small"
    language: str = "vi"
    beam_size: int = 5
    compute_type: str = "float16"
    device: str = "auto"


@dataclass(frozen=True)
class Settings:
    segments: Spans = field(default_factory=Spans)
    cleaning: Cleaning = field(default_factory=Cleaning)
    audio_quality: Signal = field(default_factory=Signal)
    stt_segmentation: Segmentation = field(default_factory=Segmentation)
    filter: Gate = field(default_factory=Gate)
    vad: Voice = field(default_factory=Voice)
    transcription: Recogniser = field(default_factory=Recogniser)

    def with_(self, group: str, **values: Any) -> Settings:
        """A copy with values of one group replaced."""
        return replace(self, **{group: replace(getattr(self, group), **values)})


# Values that hold where a file has the section but not the key, and older spellings of keys.
_WHERE_MISSING = {("segments", "max_sec"): 10.0, ("filter", "max_sec"): 10.0}
_OLDER = {"min_seconds": "min_sec", "max_seconds": "max_sec", "max_silence_gap_seconds": "merge_gap_sec"}


def _cast(value: Any, kind: str) -> Any:
    if value is None or value == "":
        return None
    if kind.startswith("float"):
        return float(value)
    if kind.startswith("int"):
        return int(value)
    if kind == "bool":
        return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "on")
    if kind.startswith("Mapping"):
        return {str(k).strip(): str(v).strip() for k, v in dict(value).items() if str(k).strip() and v is not None and str(v).strip()}
    return str(value)


def from_mapping(raw: Mapping[str, Any] | None) -> Settings:
    """Settings from nested mappings; unknown sections and keys are ignored, a section that is no mapping is an error."""
    raw = raw or {}
    groups = {}
    for group in fields(Settings):
        section = raw.get(group.name)
        if section is None:
            section = {}
        if not isinstance(section, Mapping):
            raise ValueError(f"section {group.name!r} must be a mapping")
        section = {_OLDER.get(k, k): v for k, v in section.items()}
        kind = type(getattr(Settings(), group.name))
        values = {}
        for f in fields(kind):
            if f.name in section:
                v = _cast(section[f.name], str(f.type))
                if v is not None or "None" in str(f.type):
                    values[f.name] = v
            elif (group.name, f.name) in _WHERE_MISSING:
                values[f.name] = _WHERE_MISSING[group.name, f.name]
        if group.name == "stt_segmentation" and "default_target_speaker" not in values and "dominant_speaker" in values:
            values["default_target_speaker"] = values["dominant_speaker"]
        groups[group.name] = kind(**values)
    return Settings(**groups)


def load(path: str) -> Settings:
    """Settings from a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f)
    if raw is not None and not isinstance(raw, Mapping):
        raise ValueError(f"{path}: the file must hold a mapping")
    return from_mapping(raw)
