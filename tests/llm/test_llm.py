"""Each operator against a brute-force version or an exact property, and over nulls, empty and long texts, ties, copies, empty tables and clashing names."""

import collections
import random
import re
import unicodedata

import numpy as np
import pytest
from oracle import compare
from pyspark.sql import functions as F

from voxloom.llm import lookalike as L
from voxloom.llm import mixing, packing, quality, quantiles, queries, repetition, tokens, truncation, turns


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, sf, name):
    compare(spark, sf, queries.queries()[name], queries.oracle_sql()[name])


# 1 --------------------------------------------------------------------------------------------------------------


def share(text):
    w = re.findall(r"[^\W_]+", unicodedata.normalize("NFC", text).lower())
    f = [0] * len(w)
    for i in range(len(w) - 3):
        if any(w[j : j + 4] == w[i : i + 4] for j in range(i)):
            f[i : i + 4] = [1] * 4
    return sum(f), len(w)


def test_repetition_brute():
    r = random.Random(3)
    for _ in range(200):
        t = " ".join(r.choice(["a", "b", "c", "Đẹp", "no."]) for _ in range(r.randint(0, 40)))
        lines = repetition.ledger(t)
        assert (sum(x[2] for x in lines), sum(x[1] for x in lines)) == share(t)


def test_repetition_rows(spark):
    loop = "một hai ba bốn " * 3
    rows = [("1", loop, 1), ("1", loop, 1), ("2", None, 2), ("3", "", 3), ("4", " \n . ", 4), ("5", "x " * 50_000, 5), ("6", "trang chủ | tin tức | liên hệ\nmột câu bình thường ở đây.", 6), ("7", "một hai ba bốn. ＭỘＴ hai ba bốn", 7)]
    df = spark.createDataFrame(rows, "id string, text string, rep int")
    got = {x.id: x for x in repetition.measure(df, "text", ["id"]).collect()}
    assert repetition.measure(df, "text", ["id"]).count() == 8
    assert got["1"].rep.repeated_words == 8 and got["1"].rejected and got["2"].rep is None and not got["2"].rejected
    assert got["3"].rep.n_words == got["4"].rep.n_words == 0 and got["5"].rep.repeated_words == 49_999
    assert dict(got["6"].rep.failed_lines) == {"navigation": 1} and got["6"].rep.kept_text == "một câu bình thường ở đây."
    assert got["7"].rep.repeated_share == 0.5
    assert repetition.measure(df.limit(0), "text", ["id"]).isEmpty()


def test_lines_without_an_end_mark(spark):
    prose = "Bà cụ vẽ lại mái ngói đỏ.\nBài cùng chuyên mục hôm nay\nCô giáo sửa chữa bến phà cũ!\nThợ gốm nói: “đi thôi.”"
    captions = prose.translate({ord(c): None for c in ".!“”"})
    df = spark.createDataFrame(list(enumerate([prose, captions, "Bà cụ đi chợ. cô giáo ở nhà"])), "id int, t string")
    got = [x.rep for x in repetition.measure(df, "t", ["id"]).orderBy("id").collect()]
    assert got[0].failed_lines == {"punctuation": 1} and got[0].lost_words == 6 and "chuyên mục" not in got[0].kept_text
    assert (got[1].lost_words, got[1].lost_share, got[1].failed_lines, got[1].kept_text) == (0, 0.0, {}, captions)
    assert got[2].failed_lines == {}


def test_recurring_lines(spark):
    """Lines of three different texts of many recur, those of copies do not; they are removed whole, and a text of little else is rejected."""
    own = [f"{w} {v} đi chợ." for w in ("Bà cụ", "Cô giáo", "Thợ gốm", "Chú bé") for v in ("không", "vừa", "đang")]
    rows = [(i, f"{t}\n[vỗ tay]\nCảm ơn các bạn.") for i, t in enumerate(own[:3])] + [(i + 3, t) for i, t in enumerate(own[3:])]
    rows += [(50 + i, "Chỉ nói một lần này thôi nhé.\nMai ta đi.") for i in range(9)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {x.id: x for x in repetition.measure(df.repartition(3), "t", ["id"]).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(own[:3]):
        assert got[i].rep.failed_lines == {"navigation": 1, "boilerplate": 1} and got[i].rep.kept_text == t and got[i].rejected
        assert got[i].rep.lost_words == 6 and got[i].rep.repeated_words == 0
    assert all(not got[i].rejected and got[i].rep.lost_words == 0 for i in got if i >= 3)


def test_hot_line(spark):
    """A line that a third of all texts hold."""
    df = spark.range(3000).selectExpr("id", "concat('Câu số ', id, ' của riêng tôi.', if(id % 3 = 0, '\n[nhạc]', '')) AS t")
    m = repetition.measure(df, "t", ["id"]).selectExpr("id % 3 = 0 AS hot", "map_keys(rep.failed_lines) AS f").distinct().collect()
    assert sorted((x.hot, x.f) for x in m) == [(False, []), (True, ["navigation"])]


# 2 --------------------------------------------------------------------------------------------------------------


def test_bands_meet_similar_texts():
    r = random.Random(1)
    hit = 0
    for _ in range(200):
        d = [r.getrandbits(32) for _ in range(60)]
        a, b = truncation.bands([d, d[:52]])
        hit += bool((a == b)[: truncation.BANDS].any())
    assert hit >= 190


def sentences(r, marks):
    who, did, what, where = ("bà cụ", "cô giáo", "thợ gốm"), ("vẽ lại", "mang theo", "sửa chữa"), ("mái ngói đỏ", "bến phà cũ", "lá thư dài"), ("ở đầu ngõ", "ngoài chợ", "bên hiên nhà")
    s = [" ".join((r.choice(who), r.choice(did), r.choice(what), r.choice(where))) for _ in range(r.randint(2, 6))]
    return (". ".join(s) + ".") if marks else " ".join(s)


def test_truncation(spark):
    r = random.Random(5)
    rows = [(f"m{i}", sentences(r, True), "marked") for i in range(400)] + [(f"p{i}", sentences(r, False), "plain") for i in range(200)]
    true = set()
    for i in range(40):  # a limit of 60 characters in a source of its own
        rows.append((f"l{i}", (sentences(r, True) + " " + sentences(r, True))[:60], "limited"))
        true.add(f"l{i}")
    rows += [(f"l{i}", sentences(r, True), "limited") for i in range(40, 400)]
    cuts = {"c1": "bà cụ vẽ lại mái ngói đỏ ở đầu ngõ. cô giáo sửa ch", "c2": "thợ gốm mang theo bến phà cũ bên hiên nhà. bà cụ vẽ lại mái", "c3": "cô giáo mang theo lá thư dài ở đầu ng�"}
    rows += [(k, v, "marked") for k, v in cuts.items()]
    fine = {"f1": "Xin chào", "f2": "cô giáo mang theo lá thư dài…", "f3": "cô giáo mang theo lá thư dài ．".replace(" ．", "．"), "f4": "", "f5": None, "f6": "hai ba " * 20}
    rows += [(k, v, "marked") for k, v in fine.items()] + [("c1", cuts["c1"], "marked")]
    df = spark.createDataFrame(rows, "id string, text string, source string")
    j = truncation.judge(df, "id", "text", "source").collect()
    cut = {x.id for x in j if x.cut}
    assert true | set(cuts) <= cut | {x.id for x in j if x.closing == "closed"}
    assert not cut & set(fine) and not {x for x in cut if x[0] == "p"} and not {x for x in cut if x[0] == "m"}
    s = {x.source: x for x in truncation.by_source(spark.createDataFrame(j)).collect()}
    assert s["marked"].cut == 3 and s["limited"].at_limit > 20
    assert truncation.judge(df.limit(0), "id", "text", "source", df.limit(0), "text").isEmpty()


def test_fuller_copy(spark):
    full = "cô giáo mang theo lá thư dài ở đầu ngõ ngày hôm qua khi trời còn sáng rồi về nhà ngay lập tức bên hiên nhà với mẹ"
    df = spark.createDataFrame([("1", full.rsplit(" ", 2)[0], "s"), ("2", "một câu khác hẳn không có bản sao nào cả ở đây", "s")], "id string, t string, source string")
    raw = spark.createDataFrame([(full + ".",), (None,)], "text string")
    j = {x.id: x for x in truncation.judge(df, "id", "t", "source", raw).collect()}
    assert j["1"].early and j["1"].cut and not j["2"].early


def test_early_ends_of_a_hot_group(spark):
    """Every text of a bucket is checked: the same as all pairs that share a bucket, in one part or in many."""
    from difflib import SequenceMatcher

    def shingles(x):
        return {tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))}

    def ends_early(x, y):
        a, b = shingles(x), shingles(y)
        if len(a & b) < 0.8 * len(a | b) - 1e-9:
            return False
        if x == y[: len(x)]:
            return len(y) > len(x)
        if x[:-1] == y[: len(x) - 1] and len(y) >= len(x) and y[len(x) - 1].startswith(x[-1]):
            return True
        k = ([None] + SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()[:-1])[-1]
        left, rest = (len(x) - k.a - k.size, len(y) - k.b - k.size) if k else (9, 0)
        return rest > 0 if left == 0 else left == 1 and rest > 0 and y[k.b + k.size].startswith(x[-1]) and (rest > 1 or y[k.b + k.size] != x[-1])

    r = random.Random(11)
    words = ["".join(r.choices("abcdeghiklmnotu", k=5)) for _ in range(400)]
    template = r.sample(words, 80)
    docs = []
    for i in range(300):
        w = list(template)
        w[r.randrange(80)] = r.choice(words)
        if i % 10 == 0:
            w = w[: -r.randint(1, 6)]
            w[-1] = w[-1][: r.choice((2, 9))]
        elif i % 10 == 1:
            w += r.sample(words, r.randint(1, 3))
        elif i % 10 == 2:
            w.insert(r.randrange(20), r.choice(words) * 3)
        docs.append(w)
    texts = [" ".join(w) for w in docs]
    df = spark.createDataFrame([(0, str(i), "s", t) for i, t in enumerate(texts)], "tbl int, id string, source string, text string")
    rows = df.repartition(2).mapInArrow(truncation._read, truncation._SCHEMA).where("kind = 0").cache()
    bands = {x.id: x.bands for x in rows.collect()}
    meet = lambda i, j: any(a == b for a, b in zip(bands[str(i)][:-1], bands[str(j)][:-1]))
    want = {str(i) for i, x in enumerate(docs) if any(i != j and texts[i] != texts[j] and meet(i, j) and ends_early(x, y) for j, y in enumerate(docs))}
    assert len(want) >= 30
    for part_chars in ((), (20_000,)):
        got = {x.id for x in truncation.early_ends(rows, *part_chars).where("near").join(rows, "k1").select("id").collect()}
        assert got == want


def limit_rows(spark, rows):
    df = spark.createDataFrame([(0, str(i), src, t) for i, (src, t) in enumerate(rows)], "tbl int, id string, source string, text string")
    return {(x.source, x.unit, x.size) for x in truncation.limits(df.mapInArrow(truncation._read, truncation._SCHEMA).where("kind = 0").drop("bands")).collect()}


def test_limits_of_small_sources(spark):
    """Six texts at one length are a limit among few others, but not where that length is usual; bytes may lose part of a character."""
    r = random.Random(2)
    long = lambda n: "".join(r.choice("abcdeghiklm ă") for _ in range(2 * n)).strip()
    rows = [("few", long(340)[:337] + "...") for _ in range(6)] + [("few", long(300)[: r.randint(40, 300)]) for _ in range(20)]
    rows += [("usual", long(340)[: 60 + r.randrange(12)]) for _ in range(70)] + [("copies", "một câu được nói lại nhiều lần trong các bản ghi âm")] * 12
    narrow = []
    while len(narrow) < 30:  # cut at 400 bytes, a broken character dropped
        t = "".join(r.choice("abcdeăờễ") for _ in range(400)).encode()[:400].decode(errors="ignore")
        narrow.append(("bytes", t))
    rows += narrow
    got = limit_rows(spark, rows)
    assert ("few", "chars", 340) in got and not {x for x in got if x[0] in ("usual", "copies")}
    assert {x for x in got if x[0] == "bytes"} == {("bytes", "bytes", n) for n in range(397, 401)}
    assert {x[1:] for x in limit_rows(spark, [("ascii", (long(200).replace("ă", "a") + "a" * 120)[:120]) for _ in range(15)])} == {("chars", 120), ("bytes", 120)}


def test_contained_in_a_fuller_text(spark):
    """A text cut to half or a fifth is found by its beginning; not one that ends where a sentence may, nor a short one."""
    r = random.Random(7)
    words = ["".join(r.choices("abcdeghiklmnotu", k=5)) for _ in range(300)]
    full = [r.choices(words, k=60) for _ in range(60)]
    rows = [(f"c{i}", " ".join(w[: 30 if i % 2 else 14])[: -2 if i % 3 else None], "s") for i, w in enumerate(full)]
    rows += [("short", " ".join(full[0][:9]), "s")]
    raw = [(" ".join(w[:8] + ["khác"] + w[9:]) if i % 4 == 3 else " ".join(w),) for i, w in enumerate(full)]
    df, copies = spark.createDataFrame(rows, "id string, t string, source string"), spark.createDataFrame(raw, "text string")
    j = {x.id: x for x in truncation.judge(df, "id", "t", "source", copies).collect()}
    missed = [i for i in range(60) if not (j[f"c{i}"].early or j[f"c{i}"].terminality >= 0.5)]
    read = spark.createDataFrame([(0, i, "s", t) for i, t, _ in rows] + [(1, None, None, t) for (t,) in raw], "tbl int, id string, source string, text string").mapInArrow(truncation._read, truncation._SCHEMA).where("kind = 0").cache()
    met = {x.id for x in truncation.early_ends(read).join(read, "k1").select("id").collect()}
    # one changed word in the opening of a fourth leaves the band for containment a chance of about a third
    assert not missed and {f"c{i}" for i in range(60) if i % 4 != 3} <= met and "short" not in met


def test_no_caps(spark):
    """Long sound notes, long phrases that loop, short torn texts."""
    note = "[" + "tiếng mưa rơi trên mái " * 12 + "]"
    rows = list(truncation._read(iter([__import__("pyarrow").RecordBatch.from_pydict({"tbl": [1], "id": ["1"], "source": ["s"], "text": [f"xin {note} chào"]})])))
    assert rows[0].column("words").to_pylist() == ["xin chào"]
    phrase = [f"w{i}" for i in range(40)]
    assert truncation.looped(["a"] + phrase * 3) and not truncation.looped(["a"] + phrase * 2) and truncation.looped(list("xabab" "ab")) and not truncation.looped(["a", "b", "a", "a"])
    r = random.Random(4)
    df = spark.createDataFrame([(f"m{i}", sentences(r, True), "s") for i in range(300)] + [("torn", "cô giáo sửa ch", "s"), ("call", "cô giáo ơi", "s")], "id string, t string, source string")
    cut = {x.id for x in truncation.judge(df, "id", "t", "source").where("cut").collect()}
    assert cut == {"torn"}
    short = [("s", ("".join(r.choice("abcdeghiklm ") for _ in range(60)))[:20]) for _ in range(40)] + [("s", ("".join(r.choice("abcdeghiklm ") for _ in range(60)) * 4)[: r.randint(30, 200)]) for _ in range(100)]
    assert ("s", "chars", 20) in limit_rows(spark, short)


# 4 --------------------------------------------------------------------------------------------------------------


def test_codes_keep_order():
    x = np.sort(np.concatenate([np.random.default_rng(0).normal(0, 50, 2000), [-1e300, -240.0, -0.0, 0.0, 1e-40, 1e300]]))
    c = quantiles.encode(x)
    assert (np.diff(c) >= 0).all() and c.min() >= 0 and c.max() < 1 << quantiles.BITS
    back = quantiles.decode(c)
    ok = (np.abs(x) > 1e-30) & (np.abs(x) < 1e38)
    assert (np.abs(back - x)[ok] <= np.abs(x)[ok] * 2.0**-10).all() and back[x == 0].tolist() == [0, 0]


def rank_error(x, value, q):
    x = np.sort(x)
    tol = abs(value) * 2.0**-10 + 1e-30
    lo, hi = np.searchsorted(x, value - tol), np.searchsorted(x, value + tol, "right")
    r = max(1, np.ceil(q * len(x)))
    return max(0, lo + 1 - r, r - hi) / len(x)


@pytest.mark.parametrize("kind", ["normal", "heavy", "ties", "floor", "uniform"])
def test_rank_error_and_merging(kind):
    g = np.random.default_rng(4)
    x = {"normal": g.normal(-20, 4, 30_000), "heavy": g.pareto(1.1, 30_000), "ties": np.round(g.gamma(2, 2, 30_000)), "floor": np.where(g.random(30_000) < 0.3, -240.0, g.normal(-20, 3, 30_000)), "uniform": g.random(30_000)}[kind]
    parts = np.zeros((3, quantiles.CELLS), np.int64)
    quantiles.add(parts, np.arange(len(x)) % 3, quantiles.encode(x), np.ones(len(x)))
    whole = np.zeros((1, quantiles.CELLS), np.int64)
    quantiles.add(whole, np.zeros(len(x), np.int64), quantiles.encode(x), np.ones(len(x)))
    assert (parts.sum(0) == whole[0]).all()
    for q, v in zip(quantiles.QUANTILES, quantiles.quantiles(whole)[0]):
        assert rank_error(x, v, q) <= 0.02
    quantiles.add(whole, np.zeros(10_000, np.int64), quantiles.encode(x[:10_000]), -np.ones(10_000))
    rest = np.zeros((1, quantiles.CELLS), np.int64)
    quantiles.add(rest, np.zeros(20_000, np.int64), quantiles.encode(x[10_000:]), np.ones(20_000))
    assert (whole == rest).all()
    assert (quantiles.from_bytes(quantiles.to_bytes(whole[0])) == whole[0]).all()


def test_sketch_tables(spark, monkeypatch):
    g = np.random.default_rng(2)
    rows = [("abc"[i % 3], None if i % 50 == 0 else float("nan") if i % 51 == 0 else float(x), float("inf"), "clash") for i, x in enumerate(g.normal(0, 1, 3000))] + [(None, 1.0, 2.0, "clash")]
    df = spark.createDataFrame(rows, "k string, v double, w double, metric string").drop("metric")
    got = {(r.k, r.metric): r for r in quantiles.answers(quantiles.merged(quantiles.sketches(df, ["k"], ["v", "w"]), ["k"])).collect()}
    assert set(got) == {("a", "v"), ("b", "v"), ("c", "v"), (None, "v"), (None, "w")}
    for k in "abc":
        x = np.array([r[1] for r in rows if r[0] == k and r[1] is not None and np.isfinite(r[1])])
        assert got[k, "v"].n == len(x) and rank_error(x, got[k, "v"].p50, 0.5) <= 0.02
    assert got[None, "v"].p50 == pytest.approx(1.0, rel=1e-3)
    gone = df.where("k = 'a'").withColumn("weight", F.lit(-1))
    both = quantiles.sketches(df, ["k"], ["v"]).unionByName(quantiles.sketches(gone, ["k"], ["v"], "weight"))
    left = {r.k: r for r in quantiles.answers(quantiles.merged(both, ["k"])).collect()}
    assert left["a"].n == 0 and left["a"].p50 is None and left["b"].p50 == got["b", "v"].p50
    assert quantiles.answers(quantiles.merged(quantiles.sketches(df.limit(0), ["k"], ["v"]), ["k"])).isEmpty()


def test_percentiles_without_copies(spark, sf, tmp_path):
    """Durations are answered too, and copied rows of both tables make no difference."""
    for name in ("accepted", "quality_metrics"):
        t = spark.read.parquet(f"{sf}/{name}.parquet").distinct()
        t.write.parquet(f"{tmp_path}/once/{name}.parquet")
        t.unionByName(t.where("pmod(hash(id), 3) = 0")).write.parquet(f"{tmp_path}/copied/{name}.parquet")
    once, copied = (sorted(map(str, queries.p4_without_copies(spark, f"{tmp_path}/{x}").collect())) for x in ("once", "copied"))
    assert once == copied and any("accepted_duration" in x for x in once)


# 5 --------------------------------------------------------------------------------------------------------------


def test_same_look(spark):
    base = "Tối thứ bảy, chị ấy đi."
    same = [base, unicodedata.normalize("NFD", base), base.replace("T", "Т"), base.replace("i", "і"), base.replace(" ", " "), base.replace(" ", "  "), base + "​", base.replace("đ", "ɖ").replace("ɖ", "đ⁠"), "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in base), base.replace("ố", "ố"), base.replace("ậ", "ậ")]
    other = [base.lower(), base.replace(".", "!"), base.replace("ố", "ô"), base.replace("7", "bảy") + "1", base.replace("chị", "chí"), ""]
    rows = [(f"s{i:02}", t, "x") for i, t in enumerate(same)] + [(f"t{i}", t, "x") for i, t in enumerate(other)] + [("n", None, "x"), ("s00", base, "x"), (None, base + "‍", "x"), ("y", base, "other table")]
    df = spark.createDataFrame(rows, "id string, text string, part string").withColumn("mapped", F.lit("clash"))
    got = {tuple(r) for r in L.same_look_pairs(df, "id", "text", "part").collect()}
    want = {("x", f"s{a:02}", f"s{b:02}") for a in range(len(same)) for b in range(a + 1, len(same)) if same[a] != same[b]}
    assert got == want
    c = L.canonicalise(df, "id", "text", "part").collect()
    assert len(c) == len(rows) and len({x.canonical for x in c if x.id and x.id[0] == "s"}) == 1
    assert next(x for x in c if x.id == "n").canonical is None and {x.canonical for x in c if x.id and x.id[0] == "t"} == set(other)
    assert len({re.sub(r"\s+", " ", L.fold(t)).strip() for t in same}) == 1
    assert L.same_look_pairs(df.limit(0), "id", "text", "part").isEmpty()


def test_marks_on_look_alikes(spark):
    a, b = "ｂѐ о̣̂", "bè ộ"
    df = spark.createDataFrame([("1", a, "p"), ("2", b, "p"), ("3", "be ộ", "p"), ("4", "x" * 200_000, "p")], "id string, text string, part string")
    assert [tuple(r) for r in L.same_look_pairs(df, "id", "text", "part").collect()] == [("p", "1", "2")]


def test_skeletons_of_all_scripts(spark):
    """Texts of any script are spread, and equal encodings have one key."""
    texts = ["你好", "再见", "สวัสดี", "さようなら", "がぎぐ", "안녕하세요", "Привет, йод", "μύλος", "नमस्ते क़लम", "مرحبا", "ộ"]
    rows = [(i, f, unicodedata.normalize(f, t)) for i, t in enumerate(texts) for f in ("NFC", "NFD")]
    got = spark.createDataFrame(rows, "i int, f string, t string").select("i", L.skeleton(L.mapped(F.col("t"))).alias("s")).distinct().collect()
    assert len(got) == len(texts) == len({x.s for x in got})


def test_pairs_of_a_hot_text(spark):
    """One text with copies in a third of all rows and one variant: as many pairs as copies."""
    df = spark.range(3000).selectExpr("cast(id as string) AS id", "if(id % 3 = 0, 'một hai', concat('câu ', id)) AS text", "'p' AS part")
    df = df.unionByName(spark.createDataFrame([("v", "một  hai", "p"), ("w", "một\u00a0hai", "p")], "id string, text string, part string"))
    got = L.same_look_pairs(df, "id", "text", "part")
    assert got.count() == 2001 and got.where("id_b = 'w'").count() == 1001


# 6 --------------------------------------------------------------------------------------------------------------

WORDS = "file_id string, index int, text string, start double, end double, type string, speaker_id string, logprob double, run string"


def stream(spark, rows):
    return spark.createDataFrame([("f", i, t, None if s is None else float(s), None if s is None else s + 0.5, ty, sp, None, "clash") for i, (t, s, ty, sp) in enumerate(rows)], WORDS)


def test_turns(spark):
    rows = [("lạc", 0, "word", None), ("[00:00:01]", 1, "word", None), ("Xin", 2, "word", "SPEAKER_00"), ("ờờờ,", 3, "word", "spk1"), ("chào", 4, "word", " speaker_0 "), ("(vỗ", 5, "word", "S1"), ("tay)", 6, "word", "S1"), ("bạn.", 7, "word", "Người nói 0"), (">> Speaker 1:", 8, "word", None), ("Vâng", 9, "word", None), ("ừ-ừ", 10, "word", None), ("cười", 11, "audio_event", None), (" ", 12, "spacing", None), ("ạ", 13, "word", None), (None, 14, "word", "spk_00"), ("à", 15, "word", None), ("rồi", 16, "word", None), ("mất", None, "word", "S3")]
    df = stream(spark, rows)
    df = df.unionByName(df.where("index = 9"))  # a copy
    for shard in (2000, 600_000):
        got = sorted(tuple(r) for r in turns.clean_turns(df, ["ờ", "ừ", "à"], shard).select("start_ms", "end_ms", "speaker_no", "n_words", "text").collect())
        assert got == [(2000, 7500, 0, 3, "Xin chào bạn."), (9000, 13500, 1, 2, "Vâng ạ"), (16000, 16500, 0, 1, "rồi")]
    assert turns.clean_turns(df.limit(0), ["ờ"]).isEmpty() and turns.clean_turns(df, []).count() > 0


def test_turns_do_not_depend_on_shards(spark):
    r = random.Random(9)
    rows = [(r.choice(["đi", "ừ", "[nhạc]", "về"]), i * 0.7, "word", r.choice([None, None, None, "S0", "spk1", "Speaker 2"])) for i in range(300)]
    df = stream(spark, rows)
    key = ["speaker_no", "start_ms", "end_ms", "n_words", "text"]
    got = [sorted(tuple(x) for x in turns.clean_turns(df, ["ừ"], s).select(*key).collect()) for s in (1000, 7000, 10**9)]
    assert got[0] == got[1] == got[2]
    last, want, cur = None, [], None
    for t, s, _, sp in rows:
        last = int(re.search(r"\d", sp)[0]) if sp else last
        if t in ("đi", "về") and last is not None:
            if cur and cur[0] == last:
                cur[2] = round((s + 0.5) * 1000)
            else:
                want.append(cur := [last, round(s * 1000), round((s + 0.5) * 1000)])
    assert [list(x[:3]) for x in sorted(got[0], key=lambda x: x[1])] == want


def test_label_clusters():
    c = turns.cluster(["SPEAKER_00", "spk0", "Người nói 0", "S1", "Speaker 1", "Anh Kiên", "AK", "anh kiên", "Lam"])
    assert len({c[x] for x in ("SPEAKER_00", "spk0", "Người nói 0")}) == 1 and c["S1"] == c["Speaker 1"] and c["S1"][1] == 1
    assert c["Anh Kiên"] == c["AK"] == c["anh kiên"] and c["Lam"][0] == "Lam" and c["Lam"][1] is None


@pytest.mark.parametrize("t", ["Ờ", "ờờờờ", "ờ-ờ", "ờ", "ờ…", " ờ. ", "ờ", "ờ"])
def test_fillers(spark, t):
    df = spark.createDataFrame([(t, "word")], "t string, ty string")
    assert df.select(turns.row_kind(F.col("t"), F.col("ty"), ["ờ", "hmm"]).alias("k")).first().k == "filler"


def test_speakers_of_a_transcript(spark):
    """Labels meet whatever their number or first letter; different numbers stay apart, also through a label without one."""
    labels = {"a": ["MC", "MC 1", "mc_01", "Dr Smith", "Mr Smith", "Guest"], "b": ["MC", "MC 1", "MC 2"], None: ["S", "S 3"]}
    df = spark.createDataFrame([(f, x) for f, own in labels.items() for x in own], "file_id string, label string")
    got = {(x.file_id, x.label): (x.speaker, x.speaker_no) for x in turns.speakers(df).collect()}
    assert len(got) == 11
    assert got["a", "MC"] == got["a", "MC 1"] == got["a", "mc_01"] and got["a", "MC"][1] == 1
    assert got["a", "Dr Smith"] == got["a", "Mr Smith"] != got["a", "Guest"]
    assert got["b", "MC"][1] is None and got["b", "MC 1"][1] == 1 and got["b", "MC 2"][1] == 2
    assert got[None, "S"] == got[None, "S 3"] and got[None, "S"][1] == 3


@pytest.mark.parametrize("similar", [0.85, 0.7])
def test_clusters_lose_no_link(similar):
    """The clusters are those of a comparison of all pairs."""
    r = random.Random(8)
    base = ["".join(r.choices("aàbđ ", k=r.randint(1, 14))).strip() or "a" for _ in range(60)]
    labels = list({x for b in base for x in (b, b[1:] + "b", b[:-1], "dr " + b, b + " 1", b.upper() + "  01", "spk 2", "Người nói 2") if x.strip()})
    got = turns.cluster(labels, similar)
    shapes = {x: turns._shape(x) for x in labels}
    plain = [x for x in labels if shapes[x][2] is None]
    up = {x: x for x in plain}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(plain):
        for b in plain[:i]:
            if shapes[a] == shapes[b] or turns._alike(shapes[a], shapes[b], similar) or turns._alike(shapes[b], shapes[a], similar):
                up[root(a)] = root(b)
    for a in plain:
        for b in plain:
            if root(a) == root(b):
                assert got[a] == got[b]
    assert got["spk 2"] == got["Người nói 2"] and len({got[x][0] for x in labels}) > 3


def test_long_and_odd_labels(spark):
    """A label of any length is a label, its number the last one; only clusters join the labels of one speaker."""
    t = spark.createDataFrame([("speaker" + " " * 100 + "7:",), ("[" + " " * 80 + "S 07" + " " * 90 + "]",), ("nói 7",), ("spk 12345678901",)], "t string")
    assert [x.n for x in t.select(turns.label_number(F.col("t")).alias("n")).collect()] == [7, 7, None, None]
    c = turns.cluster(["team 2 speaker 1", "team 2 speaker 3", "Team 2 Speaker 01"])
    assert [c[x][1] for x in ("team 2 speaker 1", "team 2 speaker 3")] == [1, 3] and c["Team 2 Speaker 01"] == c["team 2 speaker 1"]
    rows = [("đi", 0, "word", "SPEAKER_00"), ("về", 1, "word", "spk0"), ("nhà", 2, "word", "Dr Minh An"), ("thôi", 3, "word", "Mr Minh An")]
    got = turns.clean_turns(stream(spark, rows), []).select("start_ms", "end_ms", "speaker_no").collect()
    assert sorted(map(tuple, got)) == [(0, 1500, 0), (2000, 3500, None)]
    names = [f"{a}{b} {c}" for a in "bcdghklmnpqrstvx" for b in ("anh", "oan", "iet", "uong") for c in ("van", "thi", "huu", "ngoc", "minh")] * 4
    assert len(turns.cluster([f"{x} {i}" for i, x in enumerate(names)])) == len(names)


# 7 --------------------------------------------------------------------------------------------------------------

TIERS = [("short", 8), ("long", 64), ("medium", 20)]


def test_packing_properties():
    r = random.Random(2)
    for _ in range(30):
        items = [(i, r.choice([1, 3, 7, 8, 9, 20, 21, 64, 65, 200])) for i in range(r.randint(0, 80))]
        rows = packing.pack_shard(items, TIERS, step=3)
        load, whole = collections.Counter(), collections.defaultdict(list)
        for name, cap, no, group, doc, piece, first, n, pos in rows:
            load[name, no, cap] += n
            whole[doc].append((piece, first, n))
        assert all(v <= cap for (_, _, cap), v in load.items())
        for doc, n in items:
            p = sorted(whole[doc])
            assert sum(x[2] for x in p) == n and [x[1] for x in p] == [64 * k for k in range(len(p))] and len(p) == -(-n // 64)
        assert set(whole) == {i for i, _ in items}
        assert rows == packing.pack_shard(list(reversed(items)), TIERS, step=3)


def test_packing_is_tight(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(i, int(min(3000, r.paretovariate(0.8) * 20))) for i in range(4000)] + [(9999, 0)], "doc_id long, n_tokens long").withColumn("shard", F.lit("clash"))
    p = packing.pack(df.drop("shard"), [("short", 512), ("medium", 2048), ("long", 8192)], shard_tokens=100_000).persist()
    assert p.agg(F.sum("n_tokens")).first()[0] == df.agg(F.sum("n_tokens")).first()[0]
    assert p.select("shard").distinct().count() > 1 and packing.report(p).where("n_containers > 20 AND unused_share > 0.1").isEmpty()
    assert packing.pack(df.limit(0), TIERS).isEmpty() and packing.pack(df, []).isEmpty()


def test_packing_of_copies_and_nulls(spark):
    """One document in a third of all rows is spread over shards; null ids are packed."""
    df = spark.range(600).selectExpr("if(id % 3 = 0, 10007, id) AS doc_id", "if(id % 3 = 0, 50L, 20L + id % 40) AS n_tokens")
    df = df.unionByName(spark.createDataFrame([(None, 30), (None, 31), (5000, None), (5001, 0)], "doc_id long, n_tokens long")).withColumn("shard", F.lit(1))
    p = packing.pack(df, [("s", 64), ("l", 256)], shard_tokens=2000).persist()
    assert p.agg(F.sum("n_tokens")).first()[0] == df.agg(F.sum("n_tokens")).first()[0]
    assert p.where("doc_id IS NULL").count() == 2 and p.where("doc_id = 10007").count() == 200
    per = [r["count"] for r in p.where("doc_id = 10007").groupBy("shard").count().collect()]
    assert len(per) > 8 and max(per) < 60 and packing.containers(p).where("unused_tokens < 0").isEmpty()


# 8 --------------------------------------------------------------------------------------------------------------


def test_mixing(spark):
    r = random.Random(3)
    rows = [(i, r.choices(["a", "b", "c", None, "x"], [60, 5, 30, 3, 2])[0], r.randint(0, 50)) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.2, 4), ("c", 0.3, 2), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    m = mixing.mix(df, t).collect()
    have, tokens_, cap = collections.Counter(), collections.Counter(), {"a": 1, "b": 4, "c": 2}
    for _, s, n in rows:
        have[s] += n
    total = min(have[s] * cap[s] / w for s, w in (("a", 0.5), ("b", 0.2), ("c", 0.3)))
    for x in m:
        assert 1 <= x.uses <= cap[x.source]
        tokens_[x.source] += x.n_tokens * x.uses
    for s, w in (("a", 0.5), ("b", 0.2), ("c", 0.3)):
        assert 0 <= total * w - tokens_[s] <= 51
    small = {x.doc_id for x in mixing.mix(df, t, 0.3).collect()}
    assert small <= {x.doc_id for x in m}
    sh = {x.source: x.actual_share for x in mixing.shares(mixing.mix(df, t), t).collect()}
    assert abs(sh["a"] - 0.5) < 0.01 and sh["absent"] == 0
    assert mixing.mix(df.limit(0), t).isEmpty() and mixing.mix(df, t.limit(0)).isEmpty()


def test_hot_place(spark):
    df = spark.createDataFrame([(7, "a", 10)] * 20 + [(i, "a", 10) for i in range(100, 120)], "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert sum(x.n_tokens for x in mixing.mix(df, t, 0.6).collect()) <= 240


def test_token_sizes(spark):
    df = spark.createDataFrame([(1, "xin chào"), (2, None), (3, ""), (4, "a" * 100_000)], "id long, text string")
    got = {x.id: x.n_tokens for x in tokens.sizes(df, ["id"]).collect()}
    assert got[1] > 0 and got[2] == got[3] == 0 and got[4] > 1000


# 9 --------------------------------------------------------------------------------------------------------------

COMMON = ["và", "của", "là", "có", "không", "ở", "the", "and", "of", "a", "in", "về", "thì", "khi"]
PROSE = [
    "Khi bà cụ về thì cô giáo và thợ gốm có một bến phà cũ ở đầu ngõ. Không ai là của riêng.",
    "khi bà cụ về thì cô giáo và thợ gốm có một bến phà cũ ở đầu ngõ không ai là của riêng",
    "Khi bà cụ về thì cô giáo\nvà thợ gốm có một bến\nphà cũ ở đầu ngõ. Không ai\nlà của riêng ai cả.",
    "- Khi nào thì bà về?\n- Bà không có ở nhà.\n– Thế thì thôi vậy.",
    "The old potter and the crew sold a boat in the yard of the town. A visitor came and went.",
]
OTHER = [
    "- mái ngói đỏ\n- bến phà cũ\n- lá thư dài ở đầu ngõ", "1\t00:10\tmái ngói đỏ\t33\n2\t00:20\tbến phà cũ\t44", "Mái ngói đỏ\nBến phà cũ\nLá thư dài\nCây cầu treo",
    "Mái ngói đỏ ........ 3\nBến phà cũ ....... 5", "mái ngói đỏ; bến phà cũ; lá thư dài; cây cầu treo", "K-h-i  b-à  c-ụ  v-ề  t-h-ì", "1253 211013 9 8453 3 53548", "§±¦÷¶ ◊§¦±¦ ¿¤¦÷¦",
    "INFO worker=3 clip=1 rms=-20.9\nWARN worker=2 clip=2 rms=-31.4", "<td>719</td>\n<span id=121>&nbsp;</span>\n<div class=\"c\">", "Ná»­a Ä'Ãªm qua ngÆ°á»i nuÃ´i ong muá»n buá»c", "tủ sổ lam đào thoa cúng chim bầu mây trống đước chợ đường lớp đước chậu buổi len",
    "1,00:45,con đường,872.5\n2,01:04,cái trống,363", "Uy0AVbY0IwBeDM5yMMc8Em1udG+VBjoZigiPrQVwj0xgV9fkWsDH7N1Ak6CfqCQV",
]


def test_quality(spark):
    texts = [*PROSE, *OTHER, None, "", " \n\t", "Khi bà cụ về thì có. " * 20_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "clash")], "doc_id long, text string, st string")
    got = {x.id: x for x in quality.judge(df, "doc_id", "text", COMMON).collect()}
    n, k = len(PROSE), len(OTHER)
    assert [i for i in range(n) if not got[i].is_prose] == []
    assert [texts[i] for i in range(n, n + k) if got[i].is_prose or not got[i].reasons] == []
    assert got[n + k].st is None and all(got[n + k + j].is_prose is None for j in range(3)) and got[n + k + 3].is_prose
    assert quality.judge(df.limit(0), "doc_id", "text", COMMON).isEmpty() and quality.judge(df, "doc_id", "text", []).count() == len(texts) + 1


# all ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_runs(spark, sf, name):
    assert queries.queries()[name](spark, sf).count() > 0
