"""Repetition inside a single text, by line-first cleaning.

Every text is cut into lines (line breaks and sentence ends). Each line is
judged by its own rules: no words at all; navigation (links between separators,
or a line without an end mark that recurs over the corpus); boilerplate (any
other line that recurs); repetition; and punctuation (no end mark in a text that
closes most of its lines with one; a text written as captions, without marks, is
not held to it). Failing lines or the repeated part of a line are removed, and
a text that loses too much is rejected. A word is repeated if it lies in a
stretch of ``n`` consecutive words that already began at an earlier word of the
same text, also across lines; it is booked to its line.

Which lines recur is learnt: lines found in at least ``RECURS`` of all different
texts, and in ``TEXTS`` of them. So copies of a text do not make its lines recur.

One pass in Python reads each text whole, linear in its words. After it only
hashes of lines are shuffled; they are counted per different text first, so a
line of a third of all texts is counted in parts. What recurs is found again by
an equi-join on the hash, and joined to the rows that have it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from voxloom.llm.lookalike import fold
from voxloom.runtime import durable

#: A word: letters with their accents, and digits.
WORD = re.compile("(?:[^\\W_][\u0300-\u036f]*)+")
#: The end of a line that is closed by a mark, perhaps inside quotes or brackets.
_MARK = re.compile(r"[.?!…。？！:;][\"”’»')\]]*\s*$")
_LINE = re.compile(r"\n|(?<=[.!?…])\s+")
# Separators between navigation links.
NAVIGATION = "|»›>→·"
#: A line recurs if it is found in this share of all different texts, and in so many.
RECURS, TEXTS = 1e-3, 3
#: Mean words between separators below which a line of three links or more is navigation.
LINK_WORDS = 4
RULES = ("no_words", "navigation", "boilerplate", "repetition", "punctuation")

_LINES = "array<struct<h:bigint,words:int,bad:int,mark:boolean,links:boolean,kept:string>>"
_LINE_ARROW = pa.struct([("h", pa.int64()), ("words", pa.int32()), ("bad", pa.int32()), ("mark", pa.bool_()), ("links", pa.bool_()), ("kept", pa.string())])


def words(text: str) -> list[str]:
    """The words of ``text`` in the form in which they are compared."""
    return WORD.findall(fold(text).lower())


def repeated(w: list[str], n: int = 4) -> bytearray:
    """One flag a word: whether it is repeated."""
    flags = bytearray(len(w))
    seen: set[tuple[str, ...]] = set()
    ones = b"\1" * n
    for i, gram in enumerate(zip(*(w[k:] for k in range(n)))):
        if gram in seen:
            flags[i : i + n] = ones
        else:
            seen.add(gram)
    return flags


def ledger(text: str, n: int = 4, with_text: bool = True) -> list[tuple[int, int, int, bool, bool, str | None]]:
    """(hash, words, repeated words, has an end mark, is links, what is left without the repeated words) of each line."""
    # a tone written apart or an invisible character must not split a word or a line
    lines = [x for x in _LINE.split(fold(text).strip()) if x.strip()]
    low = [x.lower() for x in lines]
    per = [WORD.findall(x) for x in low]
    flags = repeated([x for p in per for x in p], n)
    out, at = [], 0
    for line, key, p in zip(lines, low, per):
        own = flags[at : at + len(p)]
        at += len(p)
        bad = sum(own)
        seps = sum(map(line.count, NAVIGATION))
        left = (" ".join(x for x, b in zip(p, own) if not b) if bad else line.strip()) if with_text else None
        out.append((xxhash.xxh3_64_intdigest(" ".join(key.split())) - (1 << 63), len(p), bad, bool(_MARK.search(line)), seps >= 2 and len(p) < LINK_WORDS * (seps + 1), left))
    return out


def _ledgers(df: DataFrame, text: str, keep: list[str], n: int, with_text: bool) -> DataFrame:
    """The columns ``keep`` with ``_row`` (its number), ``_t`` (hash of the text) and ``_lines`` (null for a null text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            lines = pa.array([None if t is None else ledger(t, n, with_text) for t in texts], pa.list_(_LINE_ARROW))
            hashes = pa.array([None if t is None else xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], hashes, lines], names=[*b.schema.names[:-1], "_t", "_lines"])

    src = df.select(*keep, F.col(text).alias("_text_of_measure"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    out = src.mapInArrow(run, ", ".join([*fields, "_t bigint", f"_lines {_LINES}"]))
    return durable(out.withColumn("_row", F.monotonically_increasing_id()), "lines")


def recurring(rows: DataFrame, share: float = RECURS, least: int = TEXTS) -> DataFrame:
    """(_h): hashes of the lines that recur over the different texts of ``rows`` (``_t``, ``_lines``).

    There are at most 1 / ``share`` times the mean number of lines of a text.
    """
    each = rows.where("_lines IS NOT NULL").select("_t", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("_h")).distinct()
    total = rows.where("_lines IS NOT NULL").agg(F.count_distinct("_t").alias("n")).first()["n"]
    return each.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(least, share * total)).select("_h")


def measure(df: DataFrame, text: str, keep: list[str], n: int = 4, max_lost: float = 0.3, with_text: bool = True) -> DataFrame:
    """The columns ``keep`` and, as struct ``rep``, what line-first cleaning found; ``rejected`` if the text lost ``max_lost`` of its words or more.

    ``rep``: n_lines, n_words, repeated_words (what the lines lose to
    repetition), repeated_share, lost_words, lost_share, failed_lines (rule ->
    lines; a line counts for the first of RULES it fails), kept_text.

    One row out for each row in. A null text has a null struct and is not
    rejected; an empty one has zeros. Other columns are ignored, so names may clash.
    """
    rows = _ledgers(df, text, keep, n, with_text)
    found = rows.select("_row", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("_h")).join(recurring(rows), "_h")
    hits = found.groupBy("_row").agg(F.collect_set("_h").alias("_hot"))
    rows = rows.join(hits, "_row", "left")

    total = lambda f: F.aggregate("_lines", F.lit(0), lambda a, x: a + f(x))
    marked = F.size(F.filter("_lines", lambda x: x["mark"])) * 2 > F.size("_lines")
    rows = rows.withColumn("_marked", marked)

    def rule(x: Column) -> Column:
        hot = F.coalesce(F.array_contains("_hot", x["h"]), F.lit(False))
        return (
            F.when(x["words"] == 0, "no_words").when(x["links"] | (hot & ~x["mark"]), "navigation").when(hot, "boilerplate")
            .when(x["bad"] * 2 > x["words"], "repetition").when(F.col("_marked") & ~x["mark"], "punctuation")
        )

    # judged once: a generator keeps later expressions from repeating it
    judged = F.transform("_lines", lambda x: F.struct(x["words"].alias("words"), x["bad"].alias("bad"), x["kept"].alias("kept"), rule(x).alias("rule")))
    rows = rows.withColumn("_lines", F.explode(F.array(judged)))
    words, bad = total(lambda x: x["words"]), total(lambda x: x["bad"])
    lost = total(lambda x: F.when(x["rule"].isNotNull(), x["words"]).otherwise(x["bad"]))
    part = lambda a: F.when(words > 0, a / words).otherwise(0.0)
    failed = F.map_filter(F.create_map(*[y for r in RULES for y in (F.lit(r), F.size(F.filter("_lines", lambda x: x["rule"] == r)))]), lambda _, v: v > 0)
    kept = F.array_join(F.transform(F.filter("_lines", lambda x: x["rule"].isNull()), lambda x: x["kept"]), "\n") if with_text else F.lit(None).cast("string")
    rep = F.struct(F.size("_lines").alias("n_lines"), words.alias("n_words"), bad.alias("repeated_words"), part(bad).alias("repeated_share"), lost.alias("lost_words"), part(lost).alias("lost_share"), failed.alias("failed_lines"), kept.alias("kept_text"))
    out = rows.select(*keep, F.when(F.col("_lines").isNotNull(), rep).alias("rep"))
    return out.withColumn("rejected", F.coalesce(F.col("rep.lost_share") >= max_lost, F.lit(False)))


def share_at_least(share: float) -> Column:
    """Whether what the lines lose to repetition reaches ``share`` of all words (exact in whole words)."""
    return (F.col("rep.n_words") > 0) & (F.col("rep.repeated_words") * 1_000_000 >= F.col("rep.n_words") * int(round(share * 1_000_000)))
