"""Text functions as columns. Only NFC runs in Python (Arrow batches); the rest stays in the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from voxloom.settings import Cleaning

# Characters that cleaning keeps beside letters, digits, marks and white space.
KEPT_MARKS = ".,?!:;\\-'"
QUOTES = "\"“”‘’`´"
EMOJI = "\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{FE00}-\\x{FE0F}"
SPACE = "\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; text that is composed already passes unchanged."""
    return s.map(lambda t: t if t is None or t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def clean(text: Column, cfg: Cleaning = Cleaning()) -> Column:
    """A transcript in its cleaned form; null becomes ''.

    Composes, drops format characters and emoji, turns every other character
    that is no letter, digit, mark, quote or common punctuation into a space,
    collapses repeated punctuation and spaces, and sets one space after and
    none before punctuation.
    """
    t = nfc(F.regexp_replace(F.coalesce(text, F.lit("")), "[\r\n\t]", " "))
    t = F.regexp_replace(t, "\\p{Cf}+" + (f"|[{EMOJI}]+" if cfg.remove_emojis else ""), "")
    t = F.regexp_replace(t, f"[^\\p{{L}}\\p{{N}}\\p{{M}}{KEPT_MARKS}{QUOTES}]+", " ")
    if cfg.strip_quotes:
        t = F.regexp_replace(t, f"^[{QUOTES}]+|[{QUOTES}]+$", "")
    t = F.regexp_replace(t, "([.,?!:;])\\1+", "$1")
    t = F.regexp_replace(t, "-{2,}", "-")
    t = F.regexp_replace(t, " +([.,?!:;])", "$1")
    t = F.regexp_replace(t, "([.,?!:;])(?=[^ ])", "$1 ")
    t = F.trim(F.regexp_replace(t, " {2,}", " "))
    return F.lower(t) if cfg.lowercase_text else t


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(f"[^{SPACE}]++"))


def unusual_symbol_ratio(text: Column) -> Column:
    """Share of characters outside letters, digits, white space, common punctuation and quotes."""
    odd = F.length(F.regexp_replace(text, f"[\\p{{L}}\\p{{N}}_{SPACE}\\x{{c0}}-\\x{{1ef9}}{KEPT_MARKS}“”‘’`´]++", ""))
    return odd / F.greatest(F.length(text), F.lit(1))


def sentence_final(text: Column) -> Column:
    return strip(text).rlike("[.!?…]+[\"')\\]]*$")


def bare_word(text: Column) -> Column:
    """Without what follows the last letter or digit."""
    return F.regexp_replace(strip(text), "[^\\p{L}\\p{N}_À-ỹ]+$", "")


def starts_upper(text: Column) -> Column:
    return text.rlike("^[\\p{Lu}\\p{Lt}]")


def starts_lower(text: Column) -> Column:
    return strip(text).rlike("^\\p{Ll}")


def join_words(words: Column) -> Column:
    """An array of words as running text: single spaces, none before punctuation."""
    t = F.array_join(F.filter(F.transform(words, strip), lambda w: w != ""), " ")
    return strip(F.regexp_replace(F.regexp_replace(t, f"[{SPACE}]+([,.?!:;])", "$1"), f"[{SPACE}]+", " "))


def safe_token(text: Column, default: str = "item", extra: str = "") -> Column:
    """A token fit for file names; runs of other characters become '_', '._-' are trimmed at the ends."""
    t = F.regexp_replace(F.regexp_replace(text, f"[^A-Za-z0-9._\\-{extra}]+", "_"), "^[._\\-]+|[._\\-]+$", "")
    return F.when(F.coalesce(t, F.lit("")) == "", default).otherwise(t)


def safe_stem(path: Column) -> Column:
    """The file name of ``path`` without its last suffix, as a safe token."""
    name = F.regexp_extract(path, "([^/]*)/*$", 1)
    return safe_token(F.regexp_replace(name, "(?<=[^.])\\.[^.]*$", ""), "audio")


def metadata_text(text: Column) -> Column:
    """Text for a bar-separated line: line breaks and bars become spaces."""
    return strip(F.translate(text, "\r\n|", "   "))


def finite(value: Column) -> Column:
    """A number, or null if it is none or not finite."""
    v = value.try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)
