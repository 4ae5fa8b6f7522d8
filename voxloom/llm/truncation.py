"""Texts that were cut off by a field limit or on their way, and how often each source cuts.

Method: near-copies are found through min-hash banding, verified pairs are
aligned, and the copy whose alignment ends early is flagged; records without
such a copy are scored by the terminality of their closing words. A text that
lost much is no near-copy of its whole, so one band is drawn from the leading
shingles alone; texts that meet there are verified by containment: so much of
the shorter one must lie in the longer one. Another text may begin with a
complete one by chance, so words that mostly close a sentence outweigh it.

Terminality is learnt from all texts that punctuate: how often two words are
followed by more speech, by the end of a sentence, or by a longer word that
begins like the second one. A text that just ends is cut if its closing words
are almost never an end, or stop inside a word; where a source closes its
sentences with marks, ending without one is evidence by itself. Calls of a few
words, phrases that occur whole again and again, and a phrase that the
recogniser kept repeating are no cut. Lengths at which a source's
unfinished texts pile up are its limits (in characters or bytes); an unfinished
text, or one that ends in an added ellipsis, is cut if it has such a length.
A text whose last sentence is closed by a mark is complete, and an ellipsis
elsewhere is speech that trails off, unless a fuller copy goes on.

One pass through Python reads all texts whole; after it only signatures, counts,
endings and the texts of shared buckets are shuffled. Equal texts share one
signature, so bands of a hot text cost what its distinct texts cost. Within a
bucket each unfinished text is checked against every other until one shows it
cut; pairs are no rows, and a large bucket is dealt over tasks in parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from voxloom.llm.lookalike import fold
from voxloom.llm.repetition import WORD
from voxloom.runtime import durable

# six bands of three find 98.6 % of the pairs of similarity 0.8
BANDS, ROWS, SHINGLE, SIMILAR = 6, 3, 5, 0.8
#: Leading shingles of the band for containment; a text of fewer, which another text may begin with by chance, has none.
LEADING = 8
#: Least share of ends among the places of closing words at which they count as an end: in a source that
#: closes its sentences with marks (less than MARKED of its texts end without), and in one that does not.
TERMINALITY_MARKED, TERMINALITY_PLAIN, MARKED = 0.6, 0.012, 0.2
#: The same for a text that is contained in a fuller one.
TERMINALITY_CONTAINED = 0.5
#: A text of so few words, if the last one is whole, or one that occurs as a whole in so many records, needs no mark to be complete.
CALL_WORDS, CALL_RECORDS = 4, 3
#: A length is a limit if so many unfinished texts come with this chance in a source without limits, and if they are this many times the mean.
LIMIT_ERROR, LIMIT_TIMES, LIMIT_NEAR = 1e-3, 12, 16
#: Counts held by a task before they are sent on.
HELD = 200_000
#: Characters of distinct texts of a bucket that a task holds at once.
PART_CHARS = 2_000_000

# an opening bracket ends the search for the closing one: linear in the text
_SOUND = re.compile(r"\[[^\[\]\n]*\]|\([^()\n]*\)|<[^<>\n]*>|♪[^♪\n]*♪|\*[^*\n]*\*|\{[^{}\n]*\}")
_ENDS = re.compile(r"[.?!…]+")
_CLOSED = re.compile(r"[.?!。？！][\"”’»')\]]*\s*$")
_ELLIPSIS = re.compile(r"(?:…|\.\.\.)[\"”’»')\]]*\s*$")
_M61 = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.Generator(np.random.PCG64(5))
_A = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

_SCHEMA = "kind int, tbl int, id string, source string, k1 bigint, k2 bigint, n_words int, n_chars int, n_bytes int, closing string, w1 string, w2 string, bands array<bigint>, words string, n_open bigint, n_closed bigint"
_ARROW = pa.schema([("kind", pa.int32()), ("tbl", pa.int32()), ("id", pa.string()), ("source", pa.string()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_words", pa.int32()), ("n_chars", pa.int32()), ("n_bytes", pa.int32()), ("closing", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("bands", pa.list_(pa.int64())), ("words", pa.string()), ("n_open", pa.int64()), ("n_closed", pa.int64())])


def closing(text: str) -> str:
    """'torn' (ends in broken bytes), 'ellipsis', 'closed' or 'open'; a reader marks an open end in a repeated phrase as 'loop'."""
    t = text.rstrip()
    if t.endswith("�"):
        return "torn"
    return "ellipsis" if _ELLIPSIS.search(t) else "closed" if _CLOSED.search(t) else "open"


def looped(w: list[str]) -> bool:
    """Whether the words end in a phrase, of any length, said three times or more."""
    if w.count(w[-1]) < 3:
        return False
    r = w[::-1]
    z, left, right = [0] * len(r), 0, 0  # z[p]: how far r goes on as it began, from p on
    for p in range(1, len(r)):
        k = min(right - p, z[p - left]) if p < right else 0
        while p + k < len(r) and r[k] == r[p + k]:
            k += 1
        z[p] = k
        if p + k > right:
            left, right = p, p + k
        if k >= 2 * p:
            return True
    return False


def shingle_hashes(docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles, where each document's begin); a document of fewer words is one shingle; none is empty."""
    sizes = np.array([max(1, len(d) - SHINGLE + 1) for d in docs])
    flat = np.concatenate([np.array(d + [0] * (SHINGLE - len(d)), np.uint64) for d in docs])
    n = np.array([max(SHINGLE, len(d)) for d in docs])
    begin = np.concatenate([[0], np.cumsum(n)[:-1]])
    with np.errstate(over="ignore"):
        h = np.zeros(len(flat) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            h = h * _M61 + flat[k : len(flat) - SHINGLE + 1 + k]
        h ^= h >> np.uint64(31)
    keep = np.repeat(begin, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return h[keep], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def bands(docs: list[list[int]]) -> np.ndarray:
    """Band hashes (documents x (BANDS + 1)); the last one, of the leading shingles, is 0 where there are fewer than LEADING."""
    h, begin = shingle_hashes(docs)
    out = np.zeros((len(docs), BANDS + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(BANDS * ROWS):
            v = h * _A[i] + _B[i]
            v ^= v >> np.uint64(32)
            out[:, i // ROWS] = out[:, i // ROWS] * _M61 + np.minimum.reduceat(v * _M61, begin)
        v = h * _A[0] + _B[1]
        v ^= v >> np.uint64(32)
    long = np.flatnonzero(np.diff(np.append(begin, len(h))) >= LEADING)
    out[long, BANDS] = np.maximum(v[begin[long, None] + np.arange(LEADING)].min(1), 1)
    return out.view(np.int64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0 (a text) and kind 1 (counts of closing words, of table 0 only)."""
    ids: dict[str, int] = {}
    opened: Counter = Counter()
    closed: Counter = Counter()

    def counts() -> Iterator[pa.RecordBatch]:
        keys = list(opened.keys() | closed.keys())
        for at in range(0, len(keys), 50_000):
            part = keys[at : at + 50_000]
            n = len(part)
            cols = {"kind": pa.array([1] * n, pa.int32()), "w1": pa.array([a for a, _ in part]), "w2": pa.array([b for _, b in part]), "n_open": pa.array([opened[k] for k in part], pa.int64()), "n_closed": pa.array([closed[k] for k in part], pa.int64())}
            yield pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(n, f.type)) for f in _ARROW], schema=_ARROW)
        opened.clear()
        closed.clear()

    for b in batches:
        rows = []
        codes = []
        for tbl, id_, source, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if text is None:
                continue
            plain = fold(text)
            low = plain.lower()
            if tbl and ("[" in low or "(" in low or "<" in low or "♪" in low or "*" in low or "{" in low):
                low = _SOUND.sub(" ", low)
            w = WORD.findall(low)
            if not w:
                continue
            end = closing(plain)
            if not tbl and (end in ("closed", "ellipsis") or _ENDS.search(low)):
                parts = [p for p in map(WORD.findall, _ENDS.split(low)) if p]
                seq = ["0" if x[0].isdigit() else x for p in parts for x in p]
                at = 0
                stops = set()
                for p in parts[: None if end == "closed" else -1]:
                    at += len(p)
                    stops.add(at - 1)
                pairs = list(zip(seq, seq[1:]))
                opened.update(pairs[:-1])  # whether the last pair is an end is what is asked
                for s in stops:
                    if s:
                        k = pairs[s - 1]
                        closed[k] += 1
                        if s < len(seq) - 1:
                            opened[k] -= 1
            joined = " ".join(w)
            d = xxhash.xxh3_128_digest(joined)
            c = []
            for x in w:
                if (i := ids.get(x)) is None:
                    if len(ids) > HELD:
                        ids.clear()
                    i = ids[x] = zlib.crc32(x.encode("utf-8", "replace")) + 1
                c.append(i)
            codes.append(c)
            w2 = "0" if w[-1][0].isdigit() else w[-1]
            w1 = "" if len(w) < 2 else "0" if w[-2][0].isdigit() else w[-2]
            if end == "open" and looped(w):
                end = "loop"
            rows.append((0, tbl, id_, source, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), len(w), len(text), len(text.encode("utf-8", "replace")), end, w1, w2, None, joined, None, None))
        for at in range(0, len(rows), 4000):
            part = list(zip(*rows[at : at + 4000]))
            sig = bands(codes[at : at + 4000])
            arrays = [pa.array(col, f.type) for col, f in zip(part, _ARROW)]
            arrays[12] = pa.ListArray.from_arrays(np.arange(0, sig.size + 1, BANDS + 1, dtype=np.int32), sig.ravel())
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)
        if len(opened) > HELD:
            yield from counts()
    yield from counts()


def limits(texts: DataFrame) -> DataFrame:
    """(source, unit, size, n): the lengths, in 'chars' or 'bytes', at which a source's unfinished texts pile up.

    Counted are different texts. Expected is the mean number of unfinished texts
    a length has: below the length, over all lengths up to the longest, or over
    the LIMIT_NEAR lengths on either side (one more than seen), whichever is most.
    A length is a limit if a Poisson count of that mean reaches its number with
    a chance (Chernoff's bound) of LIMIT_ERROR for all lengths together. A limit
    whose texts mostly lie at a larger one in the other unit only reflects it. A
    limit in bytes may cut a character, whose rest is then dropped: lengths up to
    three below are the same limit, unless it is one in characters as well.
    """
    sizes = [F.struct(F.lit(u).alias("unit"), F.col(a).alias("size"), F.col(b).alias("other")) for u, a, b in (("chars", "n_chars", "n_bytes"), ("bytes", "n_bytes", "n_chars"))]
    unfinished = texts.where("closing <> 'closed'").select("source", "k1", "k2", F.inline(F.array(*sizes)))
    both = unfinished.groupBy("source", "unit", "size", "other").agg(F.count_distinct("k1", "k2").alias("n"))
    hist = both.groupBy("source", "unit", "size").agg(F.sum("n").alias("n"), F.max_by("other", "n").alias("other"), F.max("n").alias("n_same"))
    # one row per source, unit and length that occurs
    near = W.partitionBy("source", "unit").orderBy("size")
    total = F.sum("n").over(near.rangeBetween(W.unboundedPreceding, W.unboundedFollowing))
    h = hist.withColumn("upto", F.sum("n").over(near.rangeBetween(W.unboundedPreceding, W.currentRow))).withColumn("all", total)
    longest = F.max("size").over(near.rangeBetween(W.unboundedPreceding, W.unboundedFollowing))
    h = h.withColumn("longest", longest)
    beside = [F.coalesce(F.sum("n").over(near.rangeBetween(a, b)), F.lit(0)) for a, b in ((-LIMIT_NEAR - 3, -4), (4, LIMIT_NEAR + 3))]
    mean = F.greatest((F.col("upto") - F.col("n")) / F.greatest(F.col("size") - 1, F.lit(1)), F.col("all") / F.greatest("longest", F.lit(1)))
    h = h.withColumn("mean", mean).withColumn("expected", F.greatest("mean", (F.greatest(*beside) + 1) / LIMIT_NEAR))
    log_chance = F.col("n") - F.col("expected") - F.col("n") * F.log(F.col("n") / F.col("expected"))
    rare = (F.col("n") > F.col("expected")) & (log_chance <= F.log(F.lit(LIMIT_ERROR) / F.col("longest")))
    found = h.where(rare & (F.col("n") >= LIMIT_TIMES * F.col("mean")))
    found = found.withColumn("higher", F.max("size").over(near.rangeBetween(1, 3)))
    found = durable(found.select("source", "unit", "size", "n", "other", "n_same", "higher"), "limits")

    # a limit in one unit shows in the other too
    shown = found.select(F.col("source").alias("_s"), F.col("unit").alias("_u"), F.col("size").alias("_o"), F.col("n").alias("_n"))
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("unit") != F.col("_u")) & (F.col("other") == F.col("_o")) & (F.col("n_same") * 2 >= F.col("n"))
    own = found.join(shown, same, "left").where("_n IS NULL OR _n <= n")
    down = F.when((F.col("unit") == "bytes") & F.col("_n").isNull() & F.col("higher").isNull(), 3).otherwise(0)
    sizes = own.select("source", "unit", F.explode(F.sequence(F.col("size") - down, F.col("size"))).alias("size"), "n")
    return sizes.groupBy("source", "unit", "size").agg(F.max("n").alias("n"))


def _model(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per closing words: n_open, n_closed, and n_longer, the places of longer words that begin like the last one."""
    m = counts.groupBy(*keys).agg(F.sum("n_open").alias("n_open"), F.sum("n_closed").alias("n_closed"))
    own = m.select(*keys, "n_open", "n_closed", F.lit(0).cast("bigint").alias("n_longer"))
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.length("w2") - 1), lambda i: F.substring("w2", F.lit(1), i)))
    longer = m.where(F.length("w2") > 1).select(*keys[:-1], cut.alias("w2"), F.lit(0).cast("bigint").alias("n_open"), F.lit(0).cast("bigint").alias("n_closed"), (F.col("n_open") + F.col("n_closed")).alias("n_longer"))
    return own.unionByName(longer).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_open", "n_closed", "n_longer")])


def _shingles(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _goes_on(x: list[str], y: list[str]) -> bool:
    """Whether the words ``x``, aligned with their near-copy ``y``, end where ``y`` goes on."""
    if x == y[: len(x)]:
        return len(y) > len(x)
    if x[:-1] == y[: len(x) - 1] and len(y) >= len(x) and y[len(x) - 1].startswith(x[-1]):
        return True
    # the last block of the alignment: what lies left of a longest match has no say in it
    m, at, on = SequenceMatcher(None, x, y, autojunk=False), 0, 0
    found = False
    while at < len(x) and on < len(y) and (k := m.find_longest_match(at, len(x), on, len(y))).size:
        at, on, found = k.a + k.size, k.b + k.size, True
    if not found:
        return False
    left, rest = len(x) - at, len(y) - on  # words behind the last common stretch
    if left == 0:
        return rest > 0
    return left == 1 and rest >= 1 and y[on].startswith(x[-1]) and (rest > 1 or y[on] != x[-1])


class _Bucket:
    """The texts of one bucket, or of one part of a large one, against which unfinished texts are checked."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.split: dict[int, tuple[list[str], set[str]]] = {}

    def add(self, text: str) -> None:
        self.texts.append(" " + text)

    def ends_early(self, text: str, band: int) -> bool:
        """Whether ``text`` ends early in any text here."""
        contained = band == BANDS
        last = " " + text[text.rfind(" ") + 1 :]
        x: list[str] = []
        sx: set[str] = set()
        for i, y in enumerate(self.texts):
            # its last word must go on there, or stand before the end
            if not 0 <= y.find(last) < len(y) - len(last):
                continue
            if contained and len(y) > len(text) + 1 and y.startswith(text, 1):
                return True
            if not x:
                x = text.split(" ")
                sx = _shingles(x)
            if i not in self.split:
                words = y[1:].split(" ")
                self.split[i] = words, _shingles(words)
            words, sy = self.split[i]
            if contained:
                if len(sx & sy) >= SIMILAR * len(sx) - 1e-9 and _goes_on(x, words):
                    return True
                continue
            if min(len(sx), len(sy)) < SIMILAR * max(len(sx), len(sy)) - 1e-9:
                continue
            common = len(sx & sy)
            if common >= SIMILAR * (len(sx) + len(sy) - common) - 1e-9 and _goes_on(x, words):
                return True
        return False


def early_ends(texts: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(k1, near) of distinct unfinished texts of table 0 that end early in a verified text of either table: in a near-copy, or one that contains them.

    Within a bucket each unfinished text is checked against all texts, until one
    shows it cut. Pairs are never rows: a bucket of more than ``part_chars``
    characters is dealt into parts, and its unfinished texts visit every part.
    """
    # the texts are told apart by 64 bits here; the same columns and condition let one shuffle of them serve all three uses
    distinct = texts.where("k1 IS NOT NULL").groupBy("k1").agg(F.first("bands").alias("bands"), F.first("words").alias("words"), F.max((F.col("tbl") == 0) & (F.col("closing") != "closed")).alias("asked"))
    # slim rows: the band in the lowest bits of the bucket; no bucket is gathered, its texts are counted in parts
    bucket = F.shiftleft("bucket", 3).bitwiseOR(F.col("band").cast("bigint"))
    members = distinct.select("k1", "asked", F.length("words").alias("n"), F.posexplode("bands").alias("band", "bucket")).where(f"band < {BANDS} OR bucket <> 0").select("k1", "asked", "n", bucket.alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.max("asked").alias("any"), F.ceil(F.sum("n") / part_chars).alias("parts")).where("size > 1 AND any").select("bucket", "parts")
    m = members.where("n > 0 AND asked IS NOT NULL").select("k1", "bucket").join(crowded, "bucket").join(distinct.where("size(bands) > 0"), "k1")
    own = F.pmod("k1", "parts")
    m = m.withColumn("own", own).withColumn("part", F.explode(F.when(F.col("asked"), F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).otherwise(F.array("own"))))
    m = m.select("bucket", "part", (F.col("part") == F.col("own")).alias("held"), "asked", "k1", "words")
    # of a part the texts it holds come first, then the unfinished ones that visit it
    m = m.repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.desc("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, here, waiting, early = None, _Bucket(), [], []

        def settle() -> None:
            early.extend((k, now[0] & 7 < BANDS) for k, text in waiting if here.ends_early(text, now[0] & 7))
            waiting.clear()

        def out() -> pa.RecordBatch:
            k, near = zip(*early)
            early.clear()
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(near)], names=["k1", "near"])

        for b in batches:
            for key, part, held, asked, k, text in zip(*(c.to_pylist() for c in b.columns)):
                if now != (key, part):
                    settle()
                    now, here = (key, part), _Bucket()
                if held:
                    here.add(text)
                if asked:
                    waiting.append((k, text))
                    if not held and len(waiting) > 1000:
                        settle()
            if len(early) > 10_000:
                yield out()
        settle()
        if early:
            yield out()

    return m.mapInArrow(run, "k1 bigint, near boolean").groupBy("k1").agg(F.max("near").alias("near"))


def judge(texts: DataFrame, id_: str, text: str, source: str, copies: DataFrame | None = None, copy_text: str = "text") -> DataFrame:
    """(id, source, closing, n_chars, n_bytes, at_limit, early, terminality, cut, reason) for every text with at least one word.

    ``copies``: further texts that may be fuller copies. Repeated rows are
    judged each. A null source is a source of its own. Texts that are null or
    without words are not listed: nothing shows that they were cut.
    ``reason``: 'ends early in a near-copy' (a record with a fuller copy is
    decided by it), 'torn bytes', 'at the limit', 'inside a word or sentence',
    or null.
    """
    src = texts.select(F.lit(0).alias("tbl"), F.col(id_).cast("string").alias("id"), F.col(source).alias("source"), F.col(text).alias("text"))
    if copies is not None:
        src = src.unionByName(copies.select(F.lit(1).alias("tbl"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("source"), F.col(copy_text).alias("text")))
    read = durable(src.mapInArrow(_read, _SCHEMA), "endings")
    rows, counts = read.where("kind = 0"), read.where("kind = 1").select("w1", "w2", "n_open", "n_closed")
    own = rows.where("tbl = 0").select("id", "source", "k1", "k2", "closing", "n_chars", "n_bytes", "n_words", "w1", "w2")

    lim = limits(own)
    by_chars = lim.where("unit = 'chars'").select(F.col("source").alias("_s"), F.col("size").alias("_c"))
    by_bytes = lim.where("unit = 'bytes'").select(F.col("source").alias("_t"), F.col("size").alias("_b"))
    asked = own.where("closing <> 'closed'")
    asked = asked.join(by_chars, F.col("source").eqNullSafe(F.col("_s")) & (F.col("n_chars") == F.col("_c")), "left").join(by_bytes, F.col("source").eqNullSafe(F.col("_t")) & (F.col("n_bytes") == F.col("_b")), "left")
    # short calls pile up at a few lengths too: they are judged by their last word alone
    asked = asked.withColumn("at_limit", (F.col("_c").isNotNull() | F.col("_b").isNotNull()) & (F.col("n_words") > CALL_WORDS)).drop("_s", "_c", "_t", "_b")

    asked = asked.join(early_ends(rows), "k1", "left")

    # records that are this text as a whole, and records that end so without a mark
    open_ = asked.where("closing = 'open' AND NOT at_limit AND near IS NULL")
    whole = open_.groupBy("k1").agg(F.count_distinct("id").alias("n_whole"))
    ends = open_.groupBy("w1", "w2").agg(F.count_distinct("id").alias("n_end"))
    marks = own.where(F.col("n_words") > CALL_WORDS).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    marks = marks.join(open_.where(F.col("n_words") > CALL_WORDS).groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("m")), F.col("source").eqNullSafe(F.col("_s")), "left")
    marks = marks.select(F.col("source").alias("_s"), (F.coalesce("m", F.lit(0)) < MARKED * F.col("n")).alias("marked"))
    two = _model(counts, ["w1", "w2"]).join(ends, ["w1", "w2"], "full").fillna(0, ["n_open", "n_closed", "n_longer", "n_end"])
    one = _model(counts.select("w2", "n_open", "n_closed"), ["w2"]).select("w2", F.col("n_open").alias("o1"), F.col("n_closed").alias("c1"), F.col("n_longer").alias("l1"))
    asked = asked.join(whole, "k1", "left").join(two, ["w1", "w2"], "left").join(one, ["w2"], "left").join(marks, F.col("source").eqNullSafe(F.col("_s")), "left")
    asked = asked.fillna(0, ["n_open", "n_closed", "n_longer", "n_end", "o1", "c1", "l1", "n_whole"]).fillna(False, ["marked"])
    seen = F.col("n_open") + F.col("n_closed") + F.col("n_longer")
    # closing words hardly seen together: the last word alone, which may be no word at all
    torn_word = (F.col("o1") + F.col("c1") == 0) & (F.col("l1") > 0) & (F.col("n_end") < CALL_RECORDS)
    alone = F.when(torn_word, 0.0).otherwise(1.0)
    asked = asked.withColumn("terminality", F.when(seen >= 3, F.col("n_closed") / seen).when(seen > 0, (F.col("n_closed") + F.col("n_end")) / (seen + F.col("n_end"))).otherwise(alone))
    asked = asked.withColumn("early", F.coalesce(F.col("near") | (F.col("terminality") < TERMINALITY_CONTAINED), F.lit(False)) & F.col("near").isNotNull())
    call = (F.col("n_words") <= CALL_WORDS) | (F.col("n_whole") >= CALL_RECORDS)
    least = F.when(F.col("marked"), TERMINALITY_MARKED).otherwise(TERMINALITY_PLAIN)
    reason = (
        F.when(F.col("early"), "ends early in a near-copy")
        .when(F.col("closing") == "torn", "torn bytes")
        .when(F.col("at_limit"), "at the limit")
        .when((F.col("closing") == "open") & (~call | torn_word) & (F.col("terminality") < least), "inside a word or sentence")
    )
    cols = ["id", "source", "closing", "n_chars", "n_bytes", "at_limit", "early", "terminality"]
    judged = asked.withColumn("reason", reason).select(*cols, "reason")
    closed = own.where("closing = 'closed'").select("id", "source", "closing", "n_chars", "n_bytes", F.lit(False).alias("at_limit"), F.lit(False).alias("early"), F.lit(1.0).alias("terminality"), F.lit(None).cast("string").alias("reason"))
    return judged.unionByName(closed).withColumn("cut", F.col("reason").isNotNull())


def by_source(judged: DataFrame) -> DataFrame:
    """(source, texts, cut, cut_share, at_limit): how often each source cuts, copied rows counted once."""
    one = judged.groupBy("source", "id").agg(F.max("cut").alias("cut"), F.max("at_limit").alias("at_limit"))
    return one.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("cut"), F.count_if("at_limit").alias("at_limit")).withColumn("cut_share", F.round(F.col("cut") / F.col("texts"), 6))


