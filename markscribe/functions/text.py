"""Text normalisation and the regular-expression dialect, as Spark expressions.

Offsets are code points of the normalised text, half open. White space and digits are those of
Unicode (``WS``, ``ND``), spelled out because Java's shorthand classes are ASCII.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from markscribe.functions.folds import let, scan

WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
ND = r"\p{Nd}"
LINE_ENDS = r"[\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Generation tokens that normalisation drops.
TOKENS = r"<\|(?:im_[A-Za-z0-9_]*|assistant|user|endoftext)(?:\|>)?"
SENTENCE_TOKENS = r"</?s>"


#: Decimal digits outside ASCII, and what each stands for.
_OTHER_DIGITS = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Nd"]
_THEIR_VALUES = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of all scripts as 0 to 9."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(text, "".join(_OTHER_DIGITS), _THEIR_VALUES)).otherwise(text)


def integer_in(text: Column) -> Column:
    """The first run of decimal digits as a number; null if there is none or it is too large."""
    return ascii_digits(F.regexp_extract(text, f"({ND}+)", 1)).try_cast("bigint")


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


#: Runs of safe characters shorter than this are not worth a range.
_LEAST_RUN = 64


@lru_cache(1)
def inert_ranges() -> list[tuple[int, int]]:
    """Long runs of characters that stay as they are under NFC whatever stands beside them: no combining class, unchanged alone, and never the second part of a composition.

    A text of such characters alone is in normal form (the quick check of the standard).
    """
    seconds = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # vowels and finals of Hangul syllables
    for c in map(chr, range(0x110000)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", "".join(chr(int(x, 16)) for x in parts)) == c:
            seconds.add(int(parts[1], 16))
    inert = lambda i: i not in seconds and not unicodedata.combining(chr(i)) and unicodedata.normalize("NFC", chr(i)) == chr(i)
    runs, start = [], None
    for i in range(0x110001):
        ok = i < 0x110000 and not 0xD800 <= i < 0xE000 and inert(i)
        if ok and start is None:
            start = i
        elif not ok and start is not None:
            if i - start >= _LEAST_RUN:
                runs.append((start, i - 1))
            start = None
    return runs


def may_change(text: Column) -> Column:
    """Whether NFC may change a text: it has a character outside ``inert_ranges``."""
    inert = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in inert_ranges())
    return text.rlike(r"[^\x00-\x7f]") & text.rlike(f"[^{inert}]")


def nfc(text: Column) -> Column:
    """Unicode NFC; only texts that it may change are sent to Python."""
    return F.coalesce(_nfc(F.when(may_change(text), text)), text)


def uni_strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def strip_tokens(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, TOKENS, ""), SENTENCE_TOKENS, "")


def normalize_text(text: Column, unicode_form: bool = True) -> Column:
    """Line ends, NFC, tabs, no-break spaces, tokens, runs of spaces and lines, outer white space."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    t = nfc(t) if unicode_form else t
    t = F.regexp_replace(F.translate(t, "\t", " "), r"\xa0+", " ")
    t = F.regexp_replace(strip_tokens(t), " {2,}", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")
    return uni_strip(t)


def logical_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n", -1), uni_strip), lambda x: x != "")


def once(value: Column) -> Column:
    """``value`` as a column that the optimizer never copies into the expressions above it.

    Those refer to it inside lambdas, where a copy would be computed again for every element. A
    nondeterministic condition that always holds (one that streams allow and the optimizer does not see
    through, as it does through ``rand() >= 0``) keeps projections from being
    collapsed.
    """
    return F.when(F.rand(0) + 1 > 0, value)


def match_spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of all matches, offsets from the pieces between them."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(at, x):
        start = at + F.length(x["piece"])
        end = start + F.length(x["match"])
        return F.struct(end.alias("state"), F.struct(start.alias("start"), end.alias("end"), x["match"].alias("text")).alias("out"))

    def spans(m: Column) -> Column:
        pairs = F.zip_with(F.slice(between, F.lit(1), F.size(m)), m, lambda p, x: F.struct(p.alias("piece"), x.alias("match")))
        return scan(pairs, F.lit(0), step, "struct<start:int,end:int,text:string>")

    return let(found, spans)
