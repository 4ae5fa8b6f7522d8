import io
import json
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import settings
from voxloom.functions import text as T
from voxloom.operators import dataset, gate, signal, spans
from voxloom.plans import pipeline
from voxloom.settings import Cleaning, Gate, Settings, Spans
from voxloom.sources import files, folders, models
from voxloom.streaming import gate as streaming


def column(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("a!!..??", "a! . ?"), ("1.5", "1. 5"), ("10:30", "10: 30"), ("bon…", "bon"), ("é", "é"), ("a​b﻿c", "abc"), (None, ""), ("a😀b", "ab"), ("x  ,y", "x, y"), ("a\n|b--c", "a b-c")])
def test_clean(spark, raw, want):
    assert column(spark, raw, T.clean) == want


def test_clean_options(spark):
    assert column(spark, "“ABC”", lambda c: T.clean(c, Cleaning(lowercase_text=True, strip_quotes=True))) == "abc"


GATE = "id string, audio_path string, duration double, cleaned_text string, is_empty_after_cleaning boolean, reject_reasons string"


def judged(spark, *row, **kw):
    return gate.decisions(spark.createDataFrame([row], GATE), Gate(**kw)).first()


def test_gate(spark):
    r = judged(spark, "1", "a.wav", 8.5, "một câu dài hơn hai mươi ký tự", False, "clash", max_chars=20)
    assert r.accepted and r.reject_reasons == []
    r = judged(spark, "1", "a.wav", 16.0, "một câu dài hơn hai mươi ký tự", False, None)
    assert r.reject_reasons == ["duration_too_long"]
    r = judged(spark, None, None, None, None, True, None)
    assert r.reject_reasons == ["empty_cleaned_text", "marked_empty_after_cleaning", "word_count_too_low", "missing_duration"] and r.id == ""
    d = gate.decisions(spark.createDataFrame([], GATE))
    assert gate.report(d).first().total_rows == 0


def test_quiet_is_for_review(spark):
    zero = dict.fromkeys(signal.METRICS, 0.0)
    df = spark.createDataFrame([{**zero, "rms_dbfs": -29.0, "duration": 5.0}, {**zero, "duration": 5.0, "clipping_ratio": float("nan")}, {**zero, "duration": None}], "duration double, " + ", ".join(f"{m} double" for m in signal.METRICS))
    r = [(x.quality_label, x.quality_reasons) for x in signal.labels(df).collect()]
    assert r == [("review", ["audio_too_quiet"]), ("bad", ["audio_analysis_failed"]), ("bad", ["duration_too_short"])]


def test_signal_against_numpy(spark):
    rng = np.random.default_rng(1)
    clips = [rng.uniform(-0.5, 0.5, n).astype(np.float32) for n in (15, 64, 40000)] + [np.zeros(50, np.float32)]
    clips[1][:10] = 0
    df = spark.createDataFrame([(i, c.tolist(), 16000) for i, c in enumerate(clips)] + [(9, [], 16000), (10, None, 16000)], "i int, samples array<float>, sample_rate int")
    r = {x.i: x for x in signal.measure(df).collect()}
    x = clips[2].astype(float)
    assert r[2].rms_dbfs == pytest.approx(20 * np.log10(np.sqrt((x**2).mean())), abs=1e-6)
    m = np.abs(np.fft.rfft(x[:32000] * np.hanning(32000))) + 1e-12
    assert r[2].spectral_flatness == pytest.approx(np.exp(np.log(m).mean()) / m.mean(), rel=1e-6)
    assert r[0].spectral_flatness == 0 and r[1].leading_silence_sec == 10 / 16000
    assert r[3].silence_ratio == 1 and r[3].trailing_silence_sec == 50 / 16000
    assert r[9].error == r[10].error == "empty audio" and r[9].rms_dbfs is None


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3)] + [(None,), (float("nan"),)], "v double")
    assert signal.nearest_rank(df, [], "v", (0.5,)).first().value == 2.0


def test_spans(spark):
    df = spark.createDataFrame([("f", 0.0, 1.0), ("f", 1.2, 2.0), ("f", 9.0, 12.0), ("g", 0.0, 20.0), ("g", None, 1.0)], "file_id string, start double, end double")
    m = spans.merge_short(spans.valid_spans(df))
    assert {(x.file_id, x.start, x.end, x.source) for x in m.collect()} == {("f", 0.0, 2.0, "vad_merged"), ("f", 9.0, 12.0, "vad_raw"), ("g", 0.0, 20.0, "vad_raw")}
    n = spans.number(spans.split_long(m)).where("file_id = 'g'").orderBy("id").collect()
    assert [(x.id, x.duration) for x in n] == [("000001", 6.667), ("000002", 6.666), ("000003", 6.667)]
    assert spans.build(spans.valid_spans(df.limit(0))).isEmpty()
    with pytest.raises(ValueError):
        Spans(min_sec=5.0, ideal_min=4.0)


def test_merge_against_plain_fold(spark):
    import random

    r, cfg = random.Random(7), Spans()
    rows = []
    for f in "abc":
        t = 0.0
        for _ in range(40):
            t += r.choice([0.1, 0.4, 0.9])
            rows.append((f, round(t, 3), round(t := t + r.choice([0.5, 1.5, 4.0]), 3)))
    want = set()
    for f in "abc":
        cur = None
        for _, s, e in [x for x in rows if x[0] == f]:
            if cur and cur[1] - cur[0] < cfg.min_sec and s - cur[1] <= cfg.merge_gap_sec and e - cur[0] <= cfg.max_sec:
                cur = (cur[0], e)
            else:
                want |= {(f, *cur)} if cur else set()
                cur = (s, e)
        want.add((f, *cur))
    got = spans.merge_short(spark.createDataFrame(rows, "file_id string, start double, end double"))
    assert {(x.file_id, x.start, x.end) for x in got.collect()} == want


def test_fold_of_one_large_file(spark):
    """A file with all the rows is folded and numbered in pieces, whatever the shards."""
    r, at, rows = random.Random(3), 0.0, []
    for _ in range(4000):
        at += r.choice([0.1, 0.3, 0.4, 0.6])
        rows.append(("f", round(at, 3), round(at + r.choice([0.5, 1.0, 2.0, 3.5]), 3)))
        at = max(at, rows[-1][2] - r.choice([0.0, 0.2]))
    df = spark.createDataFrame(rows, "file_id string, start double, end double")
    got = [sorted(map(tuple, spans.number(spans.merge_short(df, shard_sec=x), shard_sec=x).collect())) for x in (7.0, 100.0, 1e9)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 500
    pieces = spans._pieces(df, Spans(), 100.0).groupBy("piece").count().agg({"count": "max"}).first()[0]
    assert pieces < 100


def test_bad_spans(spark):
    df = spark.createDataFrame([("f", 0.0, 1.0), ("f", -1.0, 1.0), ("f", 2.0, 1.0), ("f", None, 1.0), ("g", float("nan"), 2.0), ("g", 0.0, float("inf"))], "file_id string, start double, end double")
    assert sorted(map(tuple, spans.bad_spans(df).collect())) == [("f", 4, 3), ("g", 2, 2)]
    assert spans.check_spans(df.limit(1)).count() == 1
    for i in range(1, 6):
        with pytest.raises(Exception, match="not a span"):
            spans.check_spans(spark.createDataFrame([df.collect()[i]], df.schema)).collect()


def test_names_and_metadata(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a_2")], "i int, n string")
    assert [x.u for x in dataset.unique_names(df, "n", ["i"], "u").orderBy("i").collect()] == ["a", "a_2", "a_2_2"]
    lines = spark.createDataFrame([("x.wav|a|b",)], "line string")
    assert tuple(dataset.parse_metadata(lines).first()) == ("x.wav", "a|b")
    for bad in ("no bar", "|text", "a/b.wav|text", "a.wav| "):
        with pytest.raises(Exception, match="not a metadata line"):
            dataset.parse_metadata(spark.createDataFrame([(bad,)], "line string")).collect()
    rows = spark.createDataFrame([("x.wav",), ("y.wav",)], "name string")
    assert [r.name for r in dataset.missing_files(rows, rows.where("name = 'x.wav'")).collect()] == ["y.wav"]
    assert column(spark, "a//b/./c/", dataset.path_key) == "a/b/c" and column(spark, "data/raw/ Tin tức.mp3", T.safe_stem) == "Tin_t_c"


def test_names_against_plain_rule(spark):
    """Each row in order takes the first free name, as one pass over all rows would give them."""
    r = random.Random(6)
    rows = [(i, r.choice("xy"), r.choice(["a", "a", "b", "a_2", "a_3", "a_2_2", "a_02", "a_1", "b_2_x", "c_12", None])) for i in range(300)]
    used, want = {"x": set(), "y": set()}, {}
    for i, k, n in rows:
        t, j = n, 2
        while n is not None and t in used[k]:
            t, j = f"{n}_{j}", j + 1
        used[k].add(t)
        want[i] = t
    df = spark.createDataFrame(rows, "i int, k string, n string").repartition(5)
    got = {x.i: x.u for x in dataset.unique_names(df, "n", ["i"], "u", ["k"]).collect()}
    assert got == want
    assert dataset.unique_names(df.limit(0), "n", ["i"], "u").isEmpty()


def test_resume(spark):
    schema = "id string, audio_path string, text string, language string, avg_logprob double, no_speech_prob double, error string, line_no int"
    prev = spark.createDataFrame([("1", "a.wav", "old", "vi", None, None, None, 1), ("1", "a.wav", "new", "vi", None, None, None, 2), ("2", "b.wav", "x", "vi", None, None, "failed", 3), ("3", None, "three", "vi", None, None, None, 4), ("4", "other.wav", "four", "vi", None, None, None, 5)], schema)
    man = spark.createDataFrame([("9", "./a.wav", 1.0), ("2", "b.wav", 1.0), ("3", "c.wav", 1.0), ("4", "d.wav", 1.0)], "id string, audio_path string, duration double")
    got = {x.id: (x.reused, x.text) for x in dataset.resume(man, prev).collect()}
    assert got == {"9": (True, "new"), "2": (False, None), "3": (True, "three"), "4": (False, None)}

    def broken(_):
        raise RuntimeError("no model")

    out = {x.id: x for x in models.transcribe(man, lambda: broken, prev, waits=()).collect()}
    assert out["2"].error == "no model" and out["2"].text == "" and out["3"].text == "three" and out["3"].error is None
    assert models.transcribe(man, models.EchoTranscriber).where("error IS NULL").count() == 4


def test_transcripts_need_their_segment(spark):
    man = spark.createDataFrame([("1", "a.wav", 1.0), ("2", "b.wav", 1.0)], "id string, audio_path string, duration double")
    seg = spark.createDataFrame([("1", "x", 0.0, 1.0)], "id string, text string, start double, end double")
    with pytest.raises(Exception, match="unknown segment"):
        dataset.transcripts(man, seg).collect()
    assert dataset.transcripts(man.limit(1), seg).first().language == "vi"


def test_export_and_files(spark, tmp_path):
    a = spark.createDataFrame([("1", True, "xin|chào\n", f"{tmp_path}/wavs/1.wav", 3.5), ("2", True, "hai", "/x/2.wav", 4.0)], "id string, accepted boolean, cleaned_text string, audio_path string, duration double")
    s = pipeline.export(a, str(tmp_path))
    assert s["total_accepted"] == 2 and s["total_duration_seconds"] == 7.5
    assert {x.value for x in spark.read.text(f"{tmp_path}/metadata.csv").collect()} == {"1.wav|xin chào", "2.wav|hai"}
    got = files.read_jsonl(spark, f"{tmp_path}/manifest.jsonl", "id string, audio_filepath string, text string, duration double")
    assert {x.audio_filepath for x in got.collect()} == {"wavs/1.wav", "/x/2.wav"}
    with pytest.raises(Exception, match="not an accepted record"):
        pipeline.export(a.withColumn("accepted", F.lit(False)), str(tmp_path))
    assert dataset.summary(a.limit(0)).first().average_duration_seconds == 0.0
    p = tmp_path / "x.jsonl"
    p.write_text('﻿{"id": "1"}\n\n{"id": \n', encoding="utf-8")
    assert files.read_jsonl(spark, str(p), "id string", strict=False).count() == 2
    with pytest.raises(Exception, match="not a JSON record"):
        files.read_jsonl(spark, str(p), "id string").collect()
    assert files.json_safe({"a": float("nan"), "b": [1, "x"]}) == {"a": None, "b": [1, "x"]}


def wav(seconds, rate=8000, channels=1, value=1000):
    b = io.BytesIO()
    with wave.open(b, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.full(int(seconds * rate) * channels, value, "<i2").tobytes())
    return b.getvalue()


def test_wav(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.WAV").write_bytes(wav(2.0, channels=2))
    (tmp_path / "y.txt").write_bytes(b"no")
    found = files.audio_listing(spark, str(tmp_path), content=True)
    h = found.select(files.wav_header("content").alias("h"), F.size(files.wav_samples("content")).alias("n")).first()
    assert (h.h.rate, h.h.channels, h.h.bits, h.h.duration, h.n) == (8000, 2, 16, 2.0, 16000)
    with pytest.raises(Exception, match="not a 16-bit mono"):
        files.check_wav(found.select(files.wav_header("content").alias("header")), 16000).collect()
    src = spark.createDataFrame([("f", bytearray(wav(2.0))), ("bad", bytearray(b"x"))], "file_id string, content binary")
    seg = spark.createDataFrame([("f", "1", 0.5, 1.25), ("f", "2", 1.5, 2.5), ("f", "3", 3.0, 4.0), ("bad", "4", 0.0, 1.0)], "file_id string, id string, start double, end double")
    got = {x.id: (x.duration, x.flag) for x in files.cut_wavs(src, seg).collect()}
    assert got == {"1": (0.75, None), "2": (0.5, "clamped"), "3": (None, "outside"), "4": (None, "unreadable")}


def test_voice(spark):
    x = np.zeros(16000, np.float32)
    x[4000:12000] = 0.3
    df = spark.createDataFrame([("f", x.tolist(), 16000), ("g", None, 16000)], "file_id string, samples array<float>, sample_rate int")
    assert [tuple(r) for r in models.detect(df, models.EnergyDetector).collect()] == [("f", 0.15, 0.85, 0.7)]


def test_settings(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("segments:\n  min_seconds: 2\nfilter:\n  min_avg_logprob: -1\nstt_segmentation:\n  dominant_speaker: speaker_2\n  per_file_target_speakers: {a: b, '': x, c: }\nunknown: 1\n")
    c = settings.load(str(p))
    assert (c.segments.min_sec, c.segments.max_sec, c.filter.max_sec, c.filter.min_avg_logprob) == (2.0, 10.0, 10.0, -1.0)
    assert c.stt_segmentation.default_target_speaker == "speaker_2" and c.stt_segmentation.per_file_target_speakers == {"a": "b"}
    assert Settings().segments.max_sec == 15.0 and Settings().with_("filter", min_words=1).filter.min_words == 1
    with pytest.raises(ValueError):
        settings.from_mapping({"segments": 3})


def test_stream(spark, sf, tmp_path):
    raw = spark.read.parquet(f"{sf}/raw_transcripts.parquet")
    raw.write.parquet(f"{tmp_path}/in")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields)
    streaming.run(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    want = gate.decisions(gate.cleaned(raw.dropDuplicates(["id", "text"])))
    assert got.count() == want.count() and got.where("accepted = 'true'").count() == want.where("accepted").count()


def test_batches(spark):
    r = spark.createDataFrame([("a", "succeeded", 1.5), ("b", "failed", None), ("c", "skipped", 2.0)], "file_id string, status string, duration_seconds double")
    assert tuple(pipeline.batch_totals(r).first()) == (3, 1, 1, 1, 3.5)
    assert json.loads(dataset.manifest_lines(spark.createDataFrame([("1", "p", "t", None)], "id string, audio_path string, cleaned_text string, duration double")).first().line) == {"id": "1", "audio_filepath": "p", "text": "t", "duration": None}


def tone(seconds, rate=16000, level=3000):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setparams((1, 2, rate, 0, "NONE", ""))
        t = np.arange(int(seconds * rate))
        w.writeframes((np.sin(t * 0.05) * level).astype("<i2").tobytes())
    return buf.getvalue()


def test_merge_of_numbered_folders(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"mc{i}_stt" / "wavs").mkdir(parents=True)
        (tmp_path / f"mc{i}_stt" / "metadata.csv").write_text("\ufeff000001.wav|xin | chào \n\n", "utf-8")
        (tmp_path / f"mc{i}_stt" / "wavs" / "000001.wav").write_bytes(tone(0.1))
    out = tmp_path / "out"
    m = folders.merge_numbered(spark, str(tmp_path), 1, 2, str(out))
    assert m == folders.Merged(2, 2, 2) and len(list((out / "wavs").iterdir())) == 2
    assert (out / "metadata.csv").read_text("utf-8") == "mc1_stt_000001.wav|xin | chào \nmc2_stt_000001.wav|xin | chào \n"
    with pytest.raises(FileExistsError):
        folders.merge_numbered(spark, str(tmp_path), 1, 2, str(out))
    assert folders.merge_numbered(spark, str(tmp_path), 2, 2, str(out), force=True).row_count == 1
    for bad, kind in (((0, 2, "x"), ValueError), ((1, 3, "x"), ValueError), ((1, 2, "mc1_stt/wavs"), ValueError)):
        with pytest.raises(kind):
            folders.merge_numbered(spark, str(tmp_path), bad[0], bad[1], str(tmp_path / bad[2]), force=True)
    (tmp_path / "mc1_stt" / "wavs" / "000001.wav").unlink()
    with pytest.raises(FileNotFoundError):
        folders.merge_numbered(spark, str(tmp_path), 1, 2, str(tmp_path / "y"))
    with pytest.raises(ValueError, match="twice"):
        folders.check_sources([str(out), str(out) + "/."], ())
    assert folders.complete_summary(str(out)) is None
    rows = spark.createDataFrame([("000001.wav", str(tmp_path / "mc2_stt"))], "audio_path string, source_dir string")
    assert folders.resolve_audio(rows).first().found == str(tmp_path / "mc2_stt" / "wavs" / "000001.wav")


def test_devices():
    assert models.resolve_device("auto", lambda: False) == "cpu" and models.resolve_device("cuda", lambda: True) == "cuda"
    assert models.resolve_compute_type("float16", "cpu") == "int8" and models.resolve_compute_type("float16", "cuda") == "float16"
    assert models.backend_name(" Local ") == "local"
    with pytest.raises(ValueError):
        models.backend_name("other")
    assert models.with_fallback(lambda d, c: (d, c) if d == "cpu" else 1 / 0, "cuda", "float16") == ("cpu", "int8")


def test_recordings_end_to_end(spark, tmp_path):
    said = "hôm nay bà cụ đi chợ mua rau về nhà nấu cơm.".split()
    words = [("r.wav", k * 11 + i, w, k * 8.0 + i * 0.6, k * 8.0 + i * 0.6 + 0.55, "word", "s0", -0.1) for k in range(3) for i, w in enumerate(said)]
    df = spark.createDataFrame(words, "file_id string, index int, text string, start double, end double, type string, speaker_id string, logprob double")
    audio = spark.createDataFrame([("r.wav", bytearray(tone(30)))], "file_id string, content binary")
    cfg = Settings().with_("audio_quality", max_spectral_flatness=1.0, review_spectral_flatness=1.0, min_rms_dbfs=-90.0, review_min_rms_dbfs=-90.0)
    s = pipeline.run_recordings(df, audio, str(tmp_path), cfg)
    assert s["total_accepted"] == 3 and 15 < s["total_duration_seconds"] < 24
    assert spark.read.text(str(tmp_path / "quality" / "good.jsonl")).count() == 3
    cut = files.cut_wavs(audio, spark.createDataFrame([("r.wav", "a", 1.0, 2.0), ("r.wav", "b", 29.5, 31.0)], "file_id string, id string, start double, end double"))
    assert files.check_cuts(cut.withColumn("expected", F.lit(1.02))).where("id = 'a'").count() == 1
    with pytest.raises(Exception, match="not as long"):
        files.check_cuts(cut.withColumn("expected", F.lit(1.5))).collect()
