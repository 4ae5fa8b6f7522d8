"""Cases of word streams, most with the settings min 3, max 15, no padding, minimum share 0.6."""

import pytest

from voxloom.operators import segmentation as S
from voxloom.operators import tokens as K
from voxloom.plans import pipeline
from voxloom.settings import Segmentation, Settings

CFG = Settings(stt_segmentation=Segmentation(boundary_pad_sec=0.0, min_speaker_share=0.6))
SCHEMA = "file_id string, index int, text string, start double, end double, type string, speaker_id string, logprob double, region string"


def stream(spark, words, file_id="f"):
    return spark.createDataFrame([(file_id, i, t, float(s), float(e), ty, sp, -0.1, "clash") for i, (t, s, e, sp, ty) in enumerate(words)], SCHEMA)


def said(text, step=0.8, length=None, speaker="speaker_0", at=0.0, type_="word"):
    return [(w, at + i * step, at + i * step + (length or step), speaker, type_) for i, w in enumerate(text.split())]


def build(spark, words, cfg=CFG):
    c = pipeline.segment_words(stream(spark, words), cfg).candidates.collect()
    return [x for x in c if not x.reject_reasons], [x for x in c if x.reject_reasons]


def test_one_speaker_one_segment(spark):
    ok, bad = build(spark, said("xin chào các bạn."))
    assert len(ok) == 1 and not bad and ok[0].text == "xin chào các bạn." and ok[0].speaker_id == "speaker_0"


def test_short_changes_of_speaker_give_nothing(spark):
    ok, bad = build(spark, said("một hai", 0.7) + said("ba bốn", 0.7, speaker="speaker_1", at=1.5) + said("năm sáu", 0.7, at=3.0))
    assert not ok and bad


def test_name_at_sentence_end_is_protected(spark):
    words = said("hôm nay tôi gặp lại bạn cũ ở Việt Nam. Giành được nhiều thứ hay.", 0.65)
    t, r = K.normalise(stream(spark, words))[0], None
    target = K.select_target(K.speaker_stats(t), CFG.stt_segmentation)
    r = S.boundary_features(S.regions(t, target, CFG.stt_segmentation), CFG.stt_segmentation)
    at = {x.text: x.protections for x in r.collect()}
    assert "protected_capitalized_entity" in at["Nam."]
    ok, _ = build(spark, words)
    assert len(ok) == 1 and ok[0].text.endswith("hay.")


def test_extended_and_overlong(spark):
    ok, bad = build(spark, said("a b c d e g h i k l m n.", 1.0))
    assert len(ok) == 1 and 10 < ok[0].duration <= 15 and not bad
    ok, bad = build(spark, said(" ".join(["từ"] * 21 + ["hết."])))
    assert len(ok) == 1 and ok[0].duration > 15 and not bad
    ok, bad = build(spark, said(" ".join(["từ"] * 25)))
    assert not ok and bad[0].reject_reasons == ["no_safe_semantic_boundary"]


@pytest.mark.parametrize("end", ["rồi...", "rồi…", "rồi.\"", "rồi?!"])
def test_ends_of_sentences(spark, end):
    ok, _ = build(spark, said(f"thế là xong {end}"))
    assert len(ok) == 1 and "sentence_punctuation" in ok[0].boundary_reasons


def test_comma_with_pause_is_no_boundary(spark):
    words = said("một hai ba bốn năm,", 0.6) + said("sáu bảy tám chín mười.", 0.6, at=3.6)
    ok, _ = build(spark, words)
    assert len(ok) == 1


def test_event_inside_and_neighbours(spark):
    ok, bad = build(spark, [*said("xin chào các bạn.", 0.85), ("[cười]", 1.5, 1.8, "speaker_0", "word")])
    assert not ok
    words = [*said("xin chào các bạn nhé.", 0.8), ("[nhạc]", 4.1, 4.5, None, "audio_event")]
    ok, bad = build(spark, words)
    assert not ok and bad[0].reject_reasons == ["risky_trailing_transition"]
    ok, bad = build(spark, [*words[:-1], ("[nhạc]", 4.3, 4.5, None, "audio_event")])
    assert len(ok) == 1


def test_targets(spark):
    words = said("a b c d.", 0.5) + said("e g h i.", 0.49, speaker="speaker_1", at=2.1) + said("k l m n.", 0.48, speaker="speaker_2", at=4.2)
    t = K.normalise(stream(spark, words, "news_a.wav"))[0]
    stats = K.speaker_stats(t)
    r = K.select_target(stats, CFG.stt_segmentation).first()
    assert r.selected_speaker == "speaker_0" and "low_speaker_share" in r.selection_warnings and "close_second_speaker" in r.selection_warnings
    per_file = Segmentation(per_file_target_speakers={"news_a.wav": "speaker_1"})
    r = K.select_target(stats, per_file).first()
    assert (r.selected_speaker, r.selection_source) == ("speaker_1", "per_file")
    r = K.select_target(stats, Segmentation(per_file_target_speakers={"data/news_a.mp3": "speaker_1"})).first()
    assert r.selected_speaker == "speaker_1"
    with pytest.raises(Exception, match="no target speaker"):
        K.select_target(stats, Segmentation(speaker_selection_mode="manual")).collect()
    with pytest.raises(Exception, match="was not found"):
        K.select_target(stats, Segmentation(default_target_speaker="nobody")).collect()
    with pytest.raises(ValueError):
        K.select_target(stats, Segmentation(speaker_selection_mode="sometimes"))


def test_walk_against_plain_rules():
    import random

    cfg, lo, hi = Segmentation(), 3.0, 15.0
    for seed in range(60):
        r = random.Random(seed)
        n = r.randint(1, 40)
        start, t = [], 0.0
        for _ in range(n):
            start.append(round(t, 3))
            t += r.choice([0.3, 0.7, 1.1])
        end = [s + 0.25 for s in start]
        final = [r.random() < 0.25 for _ in range(n)]
        closed = [f or i == n - 1 for i, f in enumerate(final)]
        guarded = [r.random() < 0.2 and i < n - 1 for i in range(n)]
        base = [8.0 * f + 8.0 * (i == n - 1) for i, f in enumerate(final)]
        got = S.walk(start, end, base, final, closed, guarded, cfg, lo, hi)
        assert [a for a, _, _ in got] == [0, *[b + 1 for _, b, _ in got[:-1]]] and got[-1][1] == n - 1
        for a, b, s in got[:-1]:
            assert s >= cfg.min_boundary_score and closed[b] and not guarded[b] and end[b] - start[a] >= lo


def test_runs_do_not_depend_on_shards(spark):
    words = [(f"w{i}", i * 0.5, i * 0.5 + (0.4 if i % 7 else 0.45), "ab"[(i // 5) % 2] if i % 11 else None, "word") for i in range(60)]
    t = K.normalise(stream(spark, words))[0]
    one = {(x["index"], x.run) for x in K.runs(t, K.is_speech(), t.speaker_id, 0.8, 1e6).collect()}
    many = {(x["index"], x.run) for x in K.runs(t, K.is_speech(), t.speaker_id, 0.8, 2.0).collect()}
    assert one == many and len(one) == 54


def test_empty(spark):
    c = pipeline.segment_words(stream(spark, []), CFG)
    assert c.candidates.isEmpty() and c.stats.isEmpty()


@pytest.mark.parametrize("last", [1e3, 1e8, 1e12, 1e300])
def test_tokens_of_any_length(spark, last):
    """A token that lasts for days overlaps the candidates inside it, and is two rows of the join."""
    cands = spark.createDataFrame([("f", 1, 1, 100.0, 104.0, "a"), ("f", 1, 2, 5000.0, 5004.0, "a"), ("g", 1, 1, 0.0, 4.0, "a")], "file_id string, region long, segment int, raw_start double, raw_end double, speaker_id string")
    rows = [("f", 0, "x", 50.0, last, "word", "b"), ("f", 1, "[cười]", 104.1, 104.5, "word", "a"), ("f", 2, "y", 90.0, 99.9, "word", "a"), ("g", 0, "z", 1.0, 2.0, "word", "a")]
    toks = spark.createDataFrame(rows, "file_id string, index int, text string, start double, end double, type string, speaker_id string")
    got = {(x.file_id, x.segment): x for x in S.neighbours(cands, toks).collect()}
    assert got["f", 1].speaker_overlap == "mixed_speaker_overlap" and got["f", 1].risky_trailing and not got["f", 1].risky_leading
    assert (("f", 2) in got) == (last > 5000) and not got["g", 1].audio_event_overlap
