"""Statistics of each document's text, and fixed-threshold rules that tell prose from lists, tables and junk.

Method: length, symbol, punctuation, bullet and common-word statistics are
computed in vectors over the characters of many texts at once, then each rule is
applied and every failure is recorded as a reason. One narrow pass over whole
texts: no shuffle, no pattern matching, no loop over characters or lines.

The statistics and the thresholds of ``RULES`` follow published filters where
those give the required result (see each rule); Vietnamese syllables are
shorter than English words, and speech has no marks, dialogue has dashes and
lines may break anywhere, so the published limits on the length of words, on
bullets and on lines without an end mark are applied to entries only.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rule -> (statistic, 'min' or 'max', threshold).
RULES: dict[str, tuple[str, str, float]] = {
    # by definition: for its greater part entries of a list or rows of a table
    "list_or_table": ("entry_share", "max", 0.5),
    # published: at least 80 % of the words hold a letter
    "few_letters": ("alphabetic_share", "min", 0.8),
    # published: at most one symbol for ten words; here one for ten characters, of all that is no sentence mark, quote or dash in its place
    "symbols": ("symbol_share", "max", 0.1),
    # published: a mean word length of 3 to 10; 2 where words are Vietnamese syllables
    "short_words": ("mean_word_length", "min", 2.0),
    "long_words": ("mean_token_length", "max", 10.0),
    # published: two stop words or more; here as a share that holds for texts of any length
    "few_common_words": ("common_at_most", "min", 0.1),
}

# Bits of a character's kind.
LETTER, DIGIT, SPACE, BREAK, UPPER = 1, 2, 4, 8, 16
# Bits of its use as a mark.
TERMINAL, CLOSING, CELL, TIGHT, BULLET, NUMERIC, PAUSE, ENUM, DASH, QUOTE = (1 << i for i in range(10))
# Which characters serve as which mark.
MARKS = {TERMINAL: ".?!…", CLOSING: "”\"’')]»", CELL: "\t|", TIGHT: ";,=", BULLET: "-–—•*▪◦‣·+>#", NUMERIC: ":.,%", PAUSE: ",:;”\"", ENUM: ".):", DASH: "-–—", QUOTE: "“”\"‘’'()«»"}
#: Characters of texts that are held at once; a longer text is held alone.
HELD = 1_000_000
#: Standard errors within which a text of few words may lack common words.
ERRORS = 1.28

STATS = ("n_chars", "n_lines", "n_words", "mean_word_length", "mean_token_length", "symbol_share", "digit_share", "letter_share", "alphabetic_share", "terminal_line_share", "bullet_line_share", "common_share", "common_at_most", "fresh_line_share", "entry_share")
_WHOLE = STATS[:3]
_SCHEMA = ", ".join(f"{c} {'bigint' if c in _WHOLE else 'double'}" for c in STATS)


@functools.cache
def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By rule, for every code point: kind, use as a mark, lower case."""
    kind, low = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        k = unicodedata.category(c)
        bits = LETTER if k[0] in "LM" else DIGIT if k[0] == "N" else SPACE if c.isspace() and c != "\n" else 0
        if k in ("Lu", "Lt"):
            bits |= UPPER
            x = c.lower()
            low[i] = ord(x) if len(x) == 1 else i
        kind[i] = bits
    kind[10] = BREAK
    use = np.zeros(0x110000, np.uint16)
    for bit, chars in MARKS.items():
        for c in chars:
            use[ord(c)] |= bit
    return kind, use, low


_POWERS = np.random.Generator(np.random.PCG64(9)).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _word_hashes(low: np.ndarray, is_letter: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One hash a word; letters behind the 64th go by the powers again."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at = np.arange(len(low)) - np.repeat(start, np.diff(np.append(start, len(low)))) if start[0] == 0 else np.concatenate([np.zeros(start[0], np.int64), np.arange(start[0], len(low)) - np.repeat(start, np.diff(np.append(start, len(low))))])
    with np.errstate(over="ignore"):
        x = (low.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x = x * _POWERS[at & 63] * is_letter
        return np.add.reduceat(x, start)


def _hash_of(word: str) -> int:
    cp = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    return int(_word_hashes(cp, np.ones(len(cp), bool), np.array([0]))[0])


def common_hashes(words: Iterable[str]) -> np.ndarray:
    """The words, in lower case and composed, as the sorted hashes that :func:`measure` takes."""
    return np.array(sorted({_hash_of(unicodedata.normalize("NFC", w).lower()) for w in words if w}), np.uint64)


def _sums(flags: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.add.reduceat(flags, start, dtype=np.int64)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def measure(texts: list[str], common: np.ndarray) -> dict[str, np.ndarray]:
    """STATS of each text, and ``has_text``. All are zero where there is nothing to count."""
    texts = [t if "\r" not in t else t.replace("\r\n", "\n").replace("\r", "\n") for t in texts]
    texts = [t if t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in texts]
    kinds, uses, lower = _kinds()
    cp = np.frombuffer(("\n".join(texts) + "\n\n\n\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    pad = 3  # characters that can be looked at behind the last one
    kind, use = kinds[cp], uses[cp]
    n = len(cp) - pad
    k, u = kind[:n], use[:n]
    letter, ink = (k & LETTER) > 0, (k & (SPACE | BREAK)) == 0
    digit = (k & DIGIT) > 0
    before = lambda f: np.concatenate([[False], f[:-1]])
    doc = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
    line = np.concatenate([[0], np.flatnonzero(k[:-1] == BREAK) + 1])
    line_doc = np.searchsorted(doc, line, "right") - 1

    # words and tokens
    word = np.flatnonzero(letter & ~before(letter))
    token = np.flatnonzero(ink & ~before(ink))
    word_doc, token_doc = np.searchsorted(doc, word, "right") - 1, np.searchsorted(doc, token, "right") - 1
    per_doc = lambda of, weights=None: np.bincount(of, weights, len(texts))
    n_words, n_tokens = per_doc(word_doc), per_doc(token_doc)
    is_common = np.zeros(len(word), bool)
    if len(common) and len(word):
        h = _word_hashes(lower[cp[:n]], letter, word)
        is_common = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h
    n_common = per_doc(word_doc, is_common)
    if len(token):
        in_token = lambda f: _sums(f & ink, token)
        token_size, token_digits = in_token(ink), in_token(digit)
        alphabetic = in_token(letter) > 0
        numeric = (token_digits > 0) & (token_digits + in_token((u & NUMERIC) > 0) == token_size)
    else:
        token_size = token_digits = np.zeros(0, np.int64)
        alphabetic = numeric = np.zeros(0, bool)

    # lines: blank ones aside, each has a first and a last token
    first_token = np.searchsorted(token, line)
    tokens_in = np.diff(np.append(first_token, len(token)))
    full = tokens_in > 0
    f = np.minimum(first_token, max(len(token) - 1, 0))
    z = np.minimum(first_token + tokens_in - 1, max(len(token) - 1, 0))
    in_line = lambda flags: _sums(flags, line)
    size, line_ink = in_line(np.ones(n, bool)) - 1, in_line(ink)
    if len(token):
        a, last = token[f], token[z] + token_size[z] - 1
        end = np.where(((u[last] & CLOSING) > 0) & (last > 0), np.maximum(last - 1, 0), last)
        ends = full & (((u[last] | u[end]) & TERMINAL) > 0)
        pauses = full & (((u[last] & (TERMINAL | PAUSE)) > 0) | ends)
        a1, tail = token_size[f], token[f] + token_size[f] - 1
        bullet = ((use[a] & BULLET) > 0) & ~((a1 == 1) & (kind[a + 1] == BREAK))
        inner = token_digits[f]
        enumerated = ((use[tail] & ENUM) > 0) & (inner <= 4) & (((inner > 0) & (inner == a1 - 1)) | ((inner > 0) & (inner == a1 - 2) & (cp[a] == ord("("))) | ((a1 == 2) & ((kind[a] & LETTER) > 0) & (cp[tail] != ord(":"))))
        marked = full & (bullet | enumerated)
        second = np.minimum(f + 1, len(token) - 1)
        rows = full & (tokens_in >= 3) & numeric[f] & numeric[second]
        upper = full & ((kind[a] & UPPER) > 0)
        number_last = numeric[z]
    else:
        ends = pauses = marked = rows = upper = number_last = np.zeros(len(line), bool)
    tight = ((u & TIGHT) > 0) & (kind[1 : n + 1] & (SPACE | BREAK) == 0) & ((kind[1 : n + 1] & DIGIT == 0) | ~before(digit))
    spread = cp[:n] == 32
    gap = spread & before(spread) & before(before(spread)) & ink[np.minimum(np.arange(n) + 1, n - 1)]
    if len(token):
        gap &= np.repeat(np.where(full, token[f], n), size + 1) <= np.arange(n)  # not the indent
    dots = cp[:n] == 46
    leaders = dots & before(dots) & before(before(dots)) & before(before(before(dots)))
    opened = ((cp[:n] == 60) & ((kind[1 : n + 1] & LETTER > 0) | np.isin(cp[1 : n + 1], (33, 47)))) | ((cp[:n] == 38) & ((kind[1 : n + 1] & LETTER > 0) | (cp[1 : n + 1] == 35)))
    cells = np.maximum.reduce([in_line((u & CELL) > 0), in_line(tight & (cp[:n] == 59)), in_line(tight & (cp[:n] == 44)), in_line(tight & (cp[:n] == 61)), in_line(gap)])
    entry = full & ((marked & ~ends) | (cells >= 2) | (rows & ~ends) | ((in_line(leaders) > 0) & number_last) | (in_line(opened) > 0))

    # a line that starts anew although the one before did not end: broken prose seldom, a list always
    full_at = np.flatnonzero(full)
    same = line_doc[full_at[1:]] == line_doc[full_at[:-1]] if len(full_at) else np.zeros(0, bool)
    fresh = np.zeros(len(line), bool)
    if len(full_at) > 1:
        fresh[full_at[1:]] = same & upper[full_at[1:]] & ~pauses[full_at[:-1]]
    of_lines = lambda w: per_doc(line_doc, w)
    n_lines, n_chars = of_lines(full), np.array([len(t) for t in texts])
    fresh_share = _share(of_lines(fresh), n_lines - 1)

    free = (kind[1 : n + 1] & (SPACE | BREAK)) > 0
    within = before(letter) & ((kind[1 : n + 1] & LETTER) > 0) & (cp[:n] != 39) & (cp[:n] != 0x2019)
    in_place = (((u & QUOTE) > 0) & ~within) | (((u & (TERMINAL | PAUSE)) > 0) & (free | ((use[1 : n + 1] & (CLOSING | TERMINAL)) > 0))) | (((u & DASH) > 0) & free & ~before(ink))
    by_doc = lambda flags: _sums(flags, doc)
    n_ink, letters, digits = by_doc(ink), by_doc(letter), by_doc(digit)
    n_ends, n_parts = by_doc((u & TERMINAL) > 0), by_doc(np.isin(cp[:n], tuple(map(ord, ",;|/#"))))
    # a text that hardly ends a sentence but keeps separating is a list within the line; a list has three entries or more
    inline = (n_ends <= n_parts / 12) & (n_parts >= 2) & (n_words < 14 * (n_parts + 1))
    entries = _share(of_lines(entry * line_ink), n_ink)
    entries = np.maximum(entries, np.where((n_lines >= 2) & (fresh_share > 0.6) & (n_ends * 4 <= n_lines), fresh_share, 0.0))
    share = _share(n_common, n_words)
    z2 = ERRORS**2
    at_most = np.where(n_words > 0, (n_common + z2 / 2 + ERRORS * np.sqrt(n_common * (n_words - n_common) / np.maximum(n_words, 1) + z2 / 4)) / (n_words + z2), 1.0)
    return {
        "n_chars": n_chars, "n_lines": n_lines.astype(np.int64), "n_words": n_words,
        "mean_word_length": _share(letters, n_words), "mean_token_length": _share(n_ink, n_tokens), "symbol_share": _share(by_doc(ink & ~letter & ~digit & ~in_place), n_ink), "digit_share": _share(digits, n_ink),
        "letter_share": _share(letters, n_ink), "alphabetic_share": _share(per_doc(token_doc, alphabetic), n_tokens),
        "terminal_line_share": _share(of_lines(ends), n_lines), "bullet_line_share": _share(of_lines(marked), n_lines),
        "common_share": share, "common_at_most": at_most, "fresh_line_share": fresh_share,
        "entry_share": np.where(inline, 1.0, np.minimum(entries, 1.0)), "has_text": n_ink > 0,
    }


def statistics(docs: DataFrame, id_: str, text: str, common: Iterable[str]) -> DataFrame:
    """(id, st, has_text): one struct of STATS for each row; null for a null text, zeros where there is nothing to count.

    ``common``: the frequent words of all languages together, as a document's
    language mark cannot be relied on. Without any, no text lacks them. Repeated
    rows are rows; columns of other names are of no concern.
    """
    hashes = common_hashes(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end] or "") <= HELD):
                    held += len(texts[end] or "")
                    end += 1
                m = measure([t or "" for t in texts[at:end]], hashes)
                null = pa.array([t is None for t in texts[at:end]])
                if not len(hashes):
                    m["common_at_most"] = np.ones(end - at)
                st = pa.StructArray.from_arrays([pa.array(m[c], pa.int64() if c in _WHOLE else pa.float64()) for c in STATS], names=list(STATS), mask=null)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), st, pa.array(m["has_text"])], names=["id", "st", "has_text"])
                at = end

    src = docs.select(F.col(id_).alias("id"), F.col(text).alias("t"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, st struct<{_SCHEMA.replace(' ', ':').replace(',:', ',')}>, has_text boolean")


def judge(docs: DataFrame, id_: str, text: str, common: Iterable[str], rules: dict[str, tuple[str, str, float]] = RULES) -> DataFrame:
    """Statistics, the reason of every failed rule in the order of ``rules``, and ``is_prose``.

    A document without text (null, empty, blank) fails no rule and has a null ``is_prose``.
    """
    s = statistics(docs, id_, text, common)
    fails = []
    for name, (stat, kind, limit) in rules.items():
        bad = F.col(f"st.{stat}") > limit if kind == "max" else F.col(f"st.{stat}") < limit
        fails.append(F.when(F.col("has_text") & bad, F.lit(name)))
    return s.withColumn("reasons", F.array_compact(F.array(*fails))).withColumn("is_prose", F.when(F.col("has_text"), F.size("reasons") == 0)).drop("has_text")
