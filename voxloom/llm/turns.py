"""Clean, ordered speaker turns out of the rows of a diarised word stream.

Method: speaker labels are normalised, the label variants of each transcript
are clustered by initials and string similarity with union-find, and turns are
collapsed under the canonical speakers.

The stream of one recording is cut into time shards. Each shard finds the
labels in force, the clean words and the runs of words under one raw label;
what crosses shards (the label named last, a turn that goes on) is carried by
one summary row and two border turns per shard. So a recording that holds a
third of all rows is spread over all its shards, and only distinct labels, not
words, are clustered.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voxloom.llm.lookalike import mapped
from voxloom.runtime import durable

SHARD_MS = 600_000
#: Names that a diariser gives to speakers it numbers. Fixed values.
ROLE_NAMES = ("speaker", "spk", "s", "người nói")
# The brackets around sound annotations.
OPEN, CLOSE = "[({<*♪", "])}>*♪"


def spelled(word: str, stretch: bool = False) -> str:
    """A regular expression for ``word`` in lower case under any encoding of its accents; with ``stretch`` each letter may be drawn out."""
    out = []
    for ch in unicodedata.normalize("NFC", word.lower()):
        d = unicodedata.normalize("NFD", ch)
        forms = {ch}
        for marks in itertools.permutations(d[1:]):
            for k in range(len(marks) + 1):
                head = unicodedata.normalize("NFC", d[0] + "".join(marks[:k]))
                if len(head) == 1 or k == 0:
                    forms.add(head + "".join(marks[k:]))
        forms |= {f.replace("\u0300", "\u0340").replace("\u0301", "\u0341") for f in forms}
        alt = "|".join(x if len(x) > 1 else ("\\" + x if not x.isalnum() and x != " " and x.isascii() else x) for x in sorted(forms, key=lambda x: (-len(x), x)))
        alt = "\\s+" if ch == " " else f"(?:{alt})" if len(forms) > 1 else alt
        out.append(alt + ("+" if stretch and ch != " " else ""))
    return "".join(out)


def label_number(text: Column) -> Column:
    """The number of a speaker label that stands in ``text`` as a row of its own; null if it is none."""
    names = "|".join(spelled(x) for x in ROLE_NAMES)
    pattern = rf"^\s*(?:>+\s*)?[\[<({{]?\s*(?:v\s+)?(?:{names})[\s_.\-]*0*(\d{{1,9}})\s*[\])>}}]?\s*[:\-–]?\s*$"
    # a label ends in a digit or a mark behind it: most rows need no more than that look
    near = text.rlike(r"\d\s*[\])>}]?\s*[:\-–]?\s*$")
    return F.when(near, F.try_to_number(F.nullif(F.regexp_extract(F.lower(text), pattern, 1), F.lit("")), F.lit("999999999")).cast("int"))


def row_kind(text: Column, type_: Column, fillers: list[str]) -> Column:
    """'blank', 'time', 'label', 'sound', 'filler' or 'word'. A null text is blank."""
    t = F.trim(F.regexp_replace(text, "[\\s\u00a0\u2000-\u200f\u2060\u3000\ufeff]+", " "))
    low = F.lower(t)
    time_ = r"^[\[(<{]?\s*(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?\s*[\])>}]?\s*(?:-->.*)?$|^-->"
    o, c = ("[" + "".join("\\" + x if x.isascii() else x for x in s) + "]" for s in (OPEN, CLOSE))
    sound = rf"^{o}.*{c}$|^{o}|{c}$"
    event = F.lower(F.coalesce(type_, F.lit(""))).contains("event")
    # most rows are letters and perhaps a mark: only a filler looks like that too
    simple = ~event & text.rlike(r"^\p{L}+[,.?!…]*$")
    kind = (
        F.when(text.isNull() | (t == ""), "blank")
        .when(low.rlike(time_), "time")
        .when(label_number(t).isNotNull(), "label")
        # an event marked as such, or brackets, whole or left open by a piece
        .when(event | t.rlike(sound), "sound")
    )
    plain = F.when(F.lit(False), "filler")
    if fillers:
        each = "|".join(rf"(?:{spelled(f, stretch=True)}[\s\-–.,!?…~:;\"'”“]*)+" for f in fillers)
        kind = kind.when(low.rlike(rf"^[\s\-–.,!?…~:;\"'”“]*(?:{each})$"), "filler")
        plain = F.when(F.lower(text).rlike(rf"^(?:{each})$"), "filler")
    # a row without any letter or digit is no word
    return F.when(simple, plain.otherwise("word")).otherwise(kind.when(~t.rlike(r"[\p{L}\p{N}]"), "sound").otherwise("word"))


def tidy(label: Column) -> Column:
    """A raw speaker label without outer or doubled spaces and invisible characters; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(mapped(label), "\\s+", " ")), F.lit(""))


# --- label variants ---------------------------------------------------------------------------------------------


def _shape(label: str) -> tuple[str, str, int | None]:
    """(letters, initials, number) of a label; the number is its last group of digits."""
    low = unicodedata.normalize("NFC", label).lower()
    groups = "".join(c if c.isdigit() else " " for c in low).split()
    number = int(groups[-1][-9:]) if groups else None
    names = ["".join(c for c in x if c.isalpha()) for x in "".join(c if c.isalpha() else " " for c in low).split()]
    return " ".join(names), "".join(x[0] for x in names), number


_ROLES = frozenset(unicodedata.normalize("NFC", x) for x in ROLE_NAMES)


def _alike(a: tuple[str, str, int | None], b: tuple[str, str, int | None], similar: float) -> bool:
    """Whether two labels of one number, or two without, name one speaker."""
    if a[2] is not None and ((a[0] in _ROLES and b[0] in _ROLES) or a[1] == b[1]):
        return True
    # names: one may be the other's initials
    if a[2] is None and any(len(x[1]) > 1 and x[1] == y[0].replace(" ", "") for x, y in ((a, b), (b, a))):
        return True
    return 2 * min(len(a[0]), len(b[0])) >= similar * (len(a[0]) + len(b[0])) and SequenceMatcher(None, a[0], b[0], autojunk=False).ratio() >= similar


def _keys(shape: tuple[str, str, int | None], similar: float) -> set[tuple[str, str]]:
    """Keys of which two alike labels of one number always share one.

    By role or initials they share those. By similarity: if strings of s letters
    together match with a ratio r or more, e <= (1 - r) s letters are unmatched
    and s - e are matched in pairs, in e + 1 stretches at most; so one stretch
    has two letters or more where s (1.5 r - 1) > 1. Shorter strings, whose
    partner may be longer by (2 - r) / r, meet by single letters too.
    """
    letters, initials, number = shape
    keys = {("initials", initials)}
    if number is None:
        keys.add(("initials", letters.replace(" ", "")))
    elif letters in _ROLES:
        keys.add(("role", ""))
    keys |= {("two", letters[i : i + 2]) for i in range(len(letters) - 1)}
    if 2 * len(letters) * similar / (2 - similar) * (1.5 * similar - 1) <= 1:
        keys |= {("one", c) for c in letters}
    return keys


def cluster(labels: list[str], similar: float = 0.85) -> dict[str, tuple[str, int | None]]:
    """Union-find over the labels of one transcript: label -> (canonical label, its number).

    Different numbers are never one speaker: a label without a number joins the
    numbered labels of its letters only if they are all one speaker. Labels
    meet where they share a key that alike labels always share, so thousands
    of different names are not compared each with each.
    """
    labels = sorted(set(labels))
    shapes = [_shape(x) for x in labels]
    up = list(range(len(labels)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    same: dict[tuple, int] = {}
    for i, s in enumerate(shapes):  # equal shapes first: as many labels as there are shapes remain
        up[root(i)] = root(same.setdefault(s, i))
    heads = sorted(same.values())
    # only labels of one number, or without, can be alike before the two kinds meet
    by_key: dict[tuple, list[int]] = {}
    for j in heads:
        met: set[int] = set()
        for k in _keys(shapes[j], similar):
            own = by_key.setdefault((shapes[j][2], k), [])
            met.update(own)
            own.append(j)
        for i in sorted(met):
            if root(i) != root(j) and _alike(shapes[i], shapes[j], similar):
                up[max(root(i), root(j))] = min(root(i), root(j))
    numbered: dict[str, list[int]] = {}
    for i in heads:
        if shapes[i][2] is not None:
            numbered.setdefault(shapes[i][0], []).append(i)
    goes: dict[int, set[int]] = {}
    for i in heads:
        if shapes[i][2] is None and shapes[i][0]:
            goes.setdefault(root(i), set()).update(root(j) for j in numbered.get(shapes[i][0], []))
    for i, to in goes.items():
        if len(to) == 1:
            up[i] = to.pop()
    best: dict[int, tuple[str, int | None]] = {}
    for i, x in enumerate(labels):
        r = root(i)
        if r not in best or (shapes[i][2] is not None and best[r][1] is None):
            best[r] = (x, shapes[i][2])
    return {x: best[root(i)] for i, x in enumerate(labels)}


def speakers(labels: DataFrame) -> DataFrame:
    """(file_id, label, speaker, speaker_no) for the distinct (file_id, label) of ``labels``.

    All labels of a transcript are clustered together; they are few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # transcripts follow one another in the sorted partition; one is held at a time
        now, held, done = None, [], []

        def close() -> None:
            c = cluster(held)
            done.extend((now[0], x, *c[x]) for x in held)
            held.clear()

        def out() -> pa.RecordBatch:
            f, x, name, no = zip(*done)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(x, pa.string()), pa.array(name, pa.string()), pa.array(no, pa.int32())], names=["file_id", "label", "speaker", "speaker_no"])

        for b in batches:
            for f, x in zip(*(b.column(i).to_pylist() for i in range(2))):
                if now != (f,):
                    if held:
                        close()
                    now = (f,)
                held.append(x)
            if len(done) > 10_000:
                yield out()
        if held:
            close()
        if done:
            yield out()

    own = labels.select("file_id", "label").repartition("file_id").sortWithinPartitions("file_id", "label")
    return own.mapInArrow(run, "file_id string, label string, speaker string, speaker_no int")


# --- turns ------------------------------------------------------------------------------------------------------


def clean_turns(words: DataFrame, fillers: Iterable[str], shard_ms: int = SHARD_MS, with_text: bool = True) -> DataFrame:
    """(file_id, speaker_no, speaker, start_ms, end_ms, n_words[, text]), one row per clean turn.

    Rows with a null, NaN or infinite time or ``end <= start`` are left out;
    the rest of a recording is ordered by start, end, index. A row without
    speaker_id belongs to the speaker named last before it, in speaker_id or by
    a label in text; a label in text overrides the speaker_id of its own row.
    Words before any name is given belong to no turn. Copied rows count once.
    A null file_id is a recording of its own. Labels that clusters give no
    number have a null speaker_no. Empty tables give no rows.
    """
    finite = lambda c: F.abs(F.col(c)) < 1e12
    src = words.select(F.col("file_id"), F.col("index").alias("i"), F.col("text"), F.col("start").alias("a"), F.col("end").alias("b"), F.col("type"), F.col("speaker_id"))
    src = src.where(finite("a") & finite("b") & ~F.isnan("a") & ~F.isnan("b") & (F.col("b") > F.col("a")))
    kind = row_kind(F.col("text"), F.col("type"), sorted(set(fillers)))
    named = F.coalesce(F.when(F.col("kind") == "label", F.concat(F.lit("speaker_"), label_number(F.trim("text")).cast("string"))), tidy(F.col("speaker_id")))
    src = src.withColumn("kind", kind).withColumn("label", named)
    src = src.select("file_id", F.floor(F.col("a") * 1000 / shard_ms).alias("shard"), "a", "b", "i", (F.col("kind") == "word").alias("w"), "label", *([F.col("text")] if with_text else []))
    # nothing else says anything; the rows are judged once for all that follows
    src = durable(src.where("w OR label IS NOT NULL"), "words")

    who = speakers(src.where("label IS NOT NULL").select("file_id", "label").distinct())

    # one shuffle and one sort carry all that happens inside a shard
    order = W.partitionBy("file_id", "shard").orderBy("a", "b", "i")
    up_to_here = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = src.withColumn("by", F.last("label", ignorenulls=True).over(up_to_here)).withColumn("again", F.coalesce((F.lag("i").over(order) == F.col("i")) & (F.lag("a").over(order) == F.col("a")) & (F.lag("b").over(order) == F.col("b")), F.lit(False)))
    last = F.max_by("label", F.struct("a", "b", "i")).alias("last")
    summary = src.where("label IS NOT NULL").groupBy("file_id", "shard").agg(last)
    said = inside.where("w AND NOT again")
    new = F.when(F.lag("by").over(order).eqNullSafe(F.col("by")) & F.lag("a").over(order).isNotNull(), 0).otherwise(1)
    said = said.withColumn("new", new).withColumn("run", F.sum("new").over(up_to_here))
    aggs = [F.min(F.struct("a", "b", "i")).alias("f"), F.max(F.struct("a", "b", "i")).alias("l"), F.count(F.lit(1)).alias("n_words"), F.first("by").alias("by")]
    if with_text:
        aggs.append(F.sort_array(F.collect_list(F.struct("a", "b", "i", "text"))).alias("parts"))
    runs = said.groupBy("file_id", "shard", "run").agg(*aggs)
    if with_text:
        runs = runs.withColumn("text", F.array_join(F.transform("parts", lambda p: F.trim(p["text"])), " ")).drop("parts")
    runs = durable(runs, "runs")

    # the label in force when a shard begins
    shards = runs.select("file_id", "shard").distinct().withColumn("last", F.lit(None).cast("string")).unionByName(summary).groupBy("file_id", "shard").agg(F.max("last").alias("last"))
    carried = F.last("last", ignorenulls=True).over(W.partitionBy("file_id").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    carry = shards.withColumn("carry", carried).select(F.col("file_id").alias("_f"), F.col("shard").alias("_s"), "carry")
    runs = runs.join(carry, runs.file_id.eqNullSafe(carry._f) & (runs.shard == carry._s), "left").withColumn("label", F.coalesce("by", "carry")).where("label IS NOT NULL").drop("_f", "_s", "by", "carry")
    who = who.select(F.col("file_id").alias("_f"), F.col("label").alias("_l"), "speaker", "speaker_no")
    runs = runs.join(who, runs.file_id.eqNullSafe(who._f) & (runs.label == who._l)).drop("_f", "_l")
    # one speaker is one cluster, whatever its labels
    runs = runs.select("file_id", "shard", "f", "l", "n_words", "speaker_no", "speaker", F.col("speaker").alias("who"), *(["text"] if with_text else []))

    in_shard = _joined(runs, ["file_id", "shard"], with_text)
    # only a shard's first and last turn can go on in another shard
    by = W.partitionBy("file_id", "shard").orderBy("f")
    edge = (F.row_number().over(by) == 1) | F.lead("f").over(by).isNull()
    in_shard = durable(in_shard.withColumn("edge", edge), "turns")
    out = in_shard.where("NOT edge").drop("edge").unionByName(_joined(in_shard.where("edge").drop("edge"), ["file_id"], with_text))
    ms = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    return out.select("file_id", "speaker_no", "speaker", ms("f.a").alias("start_ms"), ms("l.b").alias("end_ms"), "n_words", *(["text"] if with_text else []))


def _joined(runs: DataFrame, keys: list[str], with_text: bool) -> DataFrame:
    """Neighbouring runs of one speaker as one, within ``keys``. With only file_id as key, the two edges of a shard join only through runs without others between them."""
    order = W.partitionBy(*keys).orderBy("f")
    before = F.lag(F.struct("who", "shard")).over(order)
    # a shard that has a first and a last edge of one speaker has another speaker's turn between them
    goes_on = (before["who"] == F.col("who")) if "shard" in keys else (before["who"] == F.col("who")) & (before["shard"] != F.col("shard"))
    turns = runs.withColumn("turn", F.sum(F.when(goes_on, 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    aggs = [F.min("f").alias("f"), F.max("l").alias("l"), F.sum("n_words").alias("n_words"), F.first("speaker_no").alias("speaker_no"), F.min("speaker").alias("speaker"), F.first("who").alias("who")]
    if "shard" not in keys:
        aggs.append(F.min("shard").alias("shard"))
    if with_text:
        aggs.append(F.sort_array(F.collect_list(F.struct("f", "text"))).alias("parts"))
    out = turns.groupBy(*keys, "turn").agg(*aggs).drop("turn")
    return out.withColumn("text", F.array_join(F.transform("parts", lambda p: p["text"]), " ")).drop("parts") if with_text else out
