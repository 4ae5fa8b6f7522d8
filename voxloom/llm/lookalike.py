"""One consistent form for texts that look the same but differ in their characters.

Method: look-alike characters are mapped in SQL, the mapped values are grouped
under an accent-sensitive Unicode collation, each equivalence class gets a
deterministic canonical member, and that member is joined back to the rows.

What counts as looking the same: canonically equivalent encodings of a letter
(composed, decomposed, marks in another order), full-width forms, spaces of
another kind or width (a run of white space equals one space, at the ends
none), invisible characters, and letters drawn alike in another alphabet.
Everything else (accent, case, digit, punctuation) is a visible difference.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voxloom.runtime import durable

# Letters of other alphabets and the Latin letters they are drawn like.
CYRILLIC = "АВЕЅІЈКМНОРСТУХЫҺԌԚԜаеѕіјорсухһԁԛԝӏүѵ"
CYRILLIC_AS = "ABESIJKMHOPCTYXЫHGQWaesijopcyxhdqwlyv"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXovcj"
LATIN = "ÐƉɑɡıℓ"
LATIN_AS = "ĐĐagil"
ARMENIAN = "օհոսցքՕՍ"
ARMENIAN_AS = "ohnugpOU"

#: Characters that leave no mark on the screen.
INVISIBLE = "\u0000-\u0008\u000e-\u001f\u007f-\u0084\u0086-\u009f\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb"
SPACE = "\\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@functools.cache
def letters() -> dict[str, str]:
    """Each look-alike letter with its Latin letter, and by rule every precomposed letter that carries marks on one."""
    base = {a: b for s, t in ((CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS), (LATIN, LATIN_AS), (ARMENIAN, ARMENIAN_AS)) for a, b in zip(s, t, strict=True) if a != b}
    out = dict(base)
    for i in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:
        d = unicodedata.normalize("NFD", c := chr(i))
        if len(d) > 1 and d[0] in base and len(to := unicodedata.normalize("NFC", base[d[0]] + d[1:])) == 1:
            out[c] = to
    return out


@functools.cache
def single() -> dict[str, str]:
    """Every one-to-one replacement: look-alike letters, full-width forms, single characters with a canonical equal."""
    out = dict(letters())
    out |= {chr(i): chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F)}
    out |= {"\u0340": "\u0300", "\u0341": "\u0301", "\u0343": "\u0313", "\u2126": "Ω", "\u212a": "K", "\u212b": "Å"}
    out |= {"￠": "¢", "￡": "£", "￢": "¬", "￣": "¯", "￤": "¦", "￥": "¥", "￦": "₩"}
    return out


def mapped(text: Column) -> Column:
    """``text`` with look-alikes replaced, invisible characters dropped and spaces made plain; its encoding of accents is left to the collation."""
    s = single()
    t = F.translate(F.regexp_replace(text, f"[{INVISIBLE}]+", ""), "".join(s), "".join(s.values()))
    t = _ordered(F.trim(F.regexp_replace(t, f"[{SPACE}]+", " ")))
    # almost all texts need none of this: one scan decides
    odd = F.translate(text, _plain(), "") != ""
    spaced = F.contains(text, F.lit("  ")) | F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    return F.when(odd | spaced, t).otherwise(text)


def _ordered(t: Column) -> Column:
    """Texts with combining marks: letters that carry marks taken apart and marks put in canonical order.

    The collation compares equal encodings as equal only if their marks are in
    canonical order, so a mark behind a composed letter has to be sorted in.
    """
    parts = F.create_map(*(F.lit(x) for c in range(0xC0, 0x1F00) if not 0x250 <= c < 0x1E00 and len(d := unicodedata.normalize("NFD", chr(c))) > 1 and (c < 0x1B1 or c >= 0x1EA0) for x in (chr(c), d)))
    t2 = F.array_join(F.transform(F.split(t, ""), lambda c: F.when(c < "\u0080", c).otherwise(F.coalesce(F.element_at(parts, c), c))), "")
    rank = {c: unicodedata.combining(chr(c)) for c in range(0x300, 0x370)}
    marks = lambda ok: "[" + "".join(chr(c) for c, r in rank.items() if r and ok(r)) + "]"
    above, below, under = marks(lambda r: r > 220), marks(lambda r: r == 220), marks(lambda r: r < 220)
    for a, b in ((above, marks(lambda r: r <= 220)), (above, marks(lambda r: r <= 220)), (below, under)):
        t2 = F.regexp_replace(t2, f"({a}+)({b}+)", "$2$1")
    return F.when(t.rlike("[\u0300-\u036f]"), t2).otherwise(t)


def skeleton(t: Column) -> Column:
    """A key that is equal for all members of a class whatever their encoding: the letters of the mapped text without their marks, hashed."""
    base = _bases()
    s = F.translate(t, "".join(base), "".join(base.values()))
    return F.xxhash64(F.regexp_replace(s, "[\\p{M}\u1160-\u11ff]+", ""))


@functools.cache
def _plain() -> str:
    """By rule: the characters of texts that need no mapping (ASCII, Latin letters composed or not, those of Vietnamese)."""
    at = [*range(0x20, 0x7F), *range(0xC0, 0x100), 0x102, 0x103, 0x110, 0x111, 0x128, 0x129, 0x168, 0x169, 0x1A0, 0x1A1, 0x1AF, 0x1B0, *range(0x1EA0, 0x1EFA)]
    return "".join(c for c in map(chr, at) if c not in single())


@functools.cache
def _bases() -> dict[str, str]:
    """By rule: every letter of any script that has a canonical decomposition, with what it begins with; a Hangul syllable begins with its first consonant."""
    out = {}
    for i in [*range(0xC0, 0xD800), *range(0xF900, 0xFB50), *range(0x11000, 0x11A00), *range(0x1D100, 0x1D200), *range(0x2F800, 0x2FA20)]:
        d = unicodedata.normalize("NFD", c := chr(i))
        if d != c and not unicodedata.category(d[0]).startswith("M"):
            out[c] = d[0]
    return out


def classes(rows: DataFrame, text: str, part: str) -> DataFrame:
    """Equivalence classes of the distinct texts of each ``part``.

    One row per distinct (part, text): ``canonical``, the class's member that is
    least (fewest characters, then binary order of the mapped text, then of the
    text), and ``variants``, the number of different strings in the class.
    Null texts are left out; an empty text is a text.

    Exact copies collapse before any text is shuffled a second time, so a text
    that makes up a third of all rows is one row here. The skeleton spreads the
    classes and leads the sort; texts are compared by collation only within it.
    """
    plain = rows.where(F.col(text).isNotNull()).select(F.col(part).alias("part"), F.col(text).alias("text")).distinct()
    keyed = plain.withColumn("mapped", mapped(F.col("text"))).withColumn("skeleton", skeleton(F.col("mapped")))
    keyed = keyed.repartition("part", "skeleton").withColumn("look", F.collate("mapped", "UNICODE"))
    by = W.partitionBy("part", "skeleton", "look")
    least = F.min(F.struct(F.length("text").alias("n"), F.col("mapped").alias("m"), F.col("text").alias("t"))).over(by)
    return keyed.withColumn("least", least).withColumn("variants", F.count(F.lit(1)).over(by)).select("part", "text", "skeleton", F.col("least.t").alias("canonical"), "variants")


def canonicalise(rows: DataFrame, id_: str, text: str, part: str) -> DataFrame:
    """Every row's (part, id, text) with the ``canonical`` text of its class and its ``variants``.

    A null text keeps null; repeated rows are kept as often as they occur.
    """
    c = classes(rows, text, part).select(F.col("part").alias("_p"), *_keys("text"), "canonical", "variants")
    r = rows.select(F.col(part).alias("part"), F.col(id_).alias("id"), F.col(text).alias("text")).select("*", *_keys("text"))
    return r.join(c, (r.part.eqNullSafe(c._p)) & (r.k1 == c.k1) & (r.k2 == c.k2), "left").select("part", "id", "text", "canonical", "variants")


def _keys(name: str) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(name).alias("k1"), F.xxhash64(F.lit(7), F.col(name)).alias("k2")]


def same_look_pairs(rows: DataFrame, id_: str, text: str, part: str) -> DataFrame:
    """(part, id_a, id_b), id_a < id_b: ids of one part whose texts look the same but are not the same string.

    Distinct rows. Only classes with two different strings or more go on, and
    different strings are paired before ids are put to them: a text with N copies
    and one variant costs N rows. Ids that are null take no part, a null part is
    a part. Two texts of one id form no pair.
    """
    multi = classes(rows, text, part).where("variants > 1").select(F.col("part").alias("p"), *_keys("text"), F.xxhash64("canonical").alias("class"), "skeleton")
    multi = durable(multi, "same-look")
    # pairs of different texts first, so copies of a text never meet one another
    a, b = (multi.select("p", "class", "skeleton", F.col("k1").alias(f"k1_{x}"), F.col("k2").alias(f"k2_{x}")) for x in "ab")
    texts = a.join(b, (a.p.eqNullSafe(b.p)) & (a["class"] == b["class"]) & (a.skeleton == b.skeleton) & (F.struct("k1_a", "k2_a") < F.struct("k1_b", "k2_b")))
    texts = texts.select(a.p, "k1_a", "k2_a", "k1_b", "k2_b")
    base = rows.where(F.col(text).isNotNull() & F.col(id_).isNotNull()).select(F.col(part).alias("part"), F.col(id_).alias("id"), *_keys(text)).distinct()
    own = base.join(multi.select("p", "k1", "k2"), (base.part.eqNullSafe(F.col("p"))) & (base.k1 == multi.k1) & (base.k2 == multi.k2), "left_semi")
    own = durable(own.select("part", "id", "k1", "k2"), "same-look-ids")
    left, right = (own.select(F.col("part").alias(f"part_{x}"), F.col("id").alias(f"id_{x}"), F.col("k1").alias(f"i1_{x}"), F.col("k2").alias(f"i2_{x}")) for x in "ab")
    j = texts.join(left, F.col("p").eqNullSafe(F.col("part_a")) & (F.col("k1_a") == F.col("i1_a")) & (F.col("k2_a") == F.col("i2_a")))
    j = j.join(right, F.col("p").eqNullSafe(F.col("part_b")) & (F.col("k1_b") == F.col("i1_b")) & (F.col("k2_b") == F.col("i2_b"))).where("id_a <> id_b")
    return j.select(F.col("p").alias("part"), F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


# The same form for code that already runs in Python.
_PLAIN = re.compile("[\\n\\t \\x21-\\x7e\u00c0-\u00cf\u00d1-\u00ff\u0102\u0103\u0110\u0111\u0128\u0129\u0168\u0169\u01a0\u01a1\u01af\u01b0\u1ea0-\u1ef9“”‘’…–♪]*")
_INVISIBLE = re.compile(f"[{INVISIBLE}]+")


@functools.cache
def _table() -> dict[int, str]:
    return {ord(a): b for a, b in single().items()}


def fold(text: str) -> str:
    """The composed plain form of ``text``; spaces are left as they are."""
    if _PLAIN.fullmatch(text):
        return text
    t = _INVISIBLE.sub("", text).translate(_table())
    # look-alikes may carry marks of their own: compose after mapping
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", t).translate(_table()))
