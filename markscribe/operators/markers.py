"""Marker detection: strong and weak question markers with exact offsets, and line predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from markscribe.functions.folds import let, scan
from markscribe.functions.text import LINE_ENDS, ND, WS, integer_in, match_spans, uni_strip

# The marker grammar.
STRONG_MARKER = rf"(?:Q{WS}*\.?{WS}*{ND}+|Question{WS}*(?:No\.?{WS}*)?{ND}+)"
STRONG = rf"(?iu)(?<![A-Za-z0-9]){STRONG_MARKER}{WS}*[.) :\-→]?(?={WS}|\z)"
WEAK = rf"\A{WS}*({ND}+{WS}*\.\)|{ND}+{WS}*[):\]]|{ND}+{WS}*\.|\({WS}*{ND}+{WS}*\)|{ND}+{WS}*→|[①②③④⑤⑥⑦⑧⑨]){WS}*"
PAGE = rf"(?iu)\A{WS}*(?:page{WS}+{ND}+|fig(?:ure)?{WS}+{ND}+(?:\.{ND}+)?|table{WS}+{ND}+(?:\.{ND}+)?|chapter{WS}+{ND}+|continued(?:{WS}+on{WS}+next{WS}+page)?){WS}*[.!:]?{WS}*\z"
CANDIDATE = "struct<pos:int,marker:string,number:bigint,start:int,end:int,strength:string,line_text:string>"


def marker_number(marker: Column) -> Column:
    return integer_in(marker)


def lines_with_offsets(text: Column) -> Column:
    """array<struct<at, line>>: lines without their ends, and where they begin."""
    step = lambda at, x: F.struct((at + F.length(x) + 1).alias("state"), F.struct(at.alias("at"), x.alias("line")).alias("out"))
    return scan(F.split(text, LINE_ENDS, -1), F.lit(0), step, "struct<at:int,line:string>")


def _candidate(marker: Column, start: Column, end: Column, strength: str, line: Column) -> Column:
    return F.struct(
        F.lit(0).alias("pos"), marker.alias("marker"), marker_number(marker).alias("number"), start.cast("int").alias("start"),
        end.cast("int").alias("end"), F.lit(strength).alias("strength"), line.alias("line_text"),
    )


def line_candidates(line: Column, at: Column) -> Column:
    """All strong markers of a line, else its weak marker at the beginning."""
    strong = lambda m: _candidate(F.regexp_extract(m["text"], rf"(?iu)\A{STRONG_MARKER}", 0), at + m["start"], at + m["end"], "strong", line)
    weak = F.array(_candidate(F.regexp_extract(line, WEAK, 1), at, at + F.length(F.regexp_extract(line, WEAK, 0)), "weak", line))
    none = F.array().cast(f"array<{CANDIDATE}>")
    return F.when(line.rlike(STRONG), F.transform(match_spans(line, STRONG), strong)).when(line.rlike(WEAK), weak).otherwise(none)


def detect_candidates(text: Column) -> Column:
    """array<CANDIDATE> in source order; ``pos`` counts from 1."""
    found = F.flatten(F.transform(lines_with_offsets(text), lambda x: line_candidates(x["line"], x["at"])))
    return let(found, lambda c: F.transform(c, lambda x, i: x.withField("pos", (i + 1).cast("int"))))


def is_page_line(text: Column) -> Column:
    return text.rlike(PAGE)


def preamble_is_header(text: Column) -> Column:
    """Empty, a page line, or one non-blank line of at most 80 characters; ``text`` is stripped."""
    lines = F.filter(F.split(text, LINE_ENDS, -1), lambda x: uni_strip(x) != "")
    return (text == "") | is_page_line(text) | ((F.size(lines) == 1) & (F.length(text) <= 80))


def preamble_bounds(text: Column) -> Column:
    """Offsets by which the preamble before any position is judged, once a document.

    ``first``: the first character that is no white space; ``line2``: that of the second line that is
    not blank; ``over80``: the first such character 80 or more after ``first``; ``words``: the end of
    the first six words (a page line has five at most).
    """
    blank = F.length(F.regexp_extract(text, rf"\A{WS}*", 0))
    line = F.length(F.regexp_extract(text, rf"\A{WS}*[^{LINE_ENDS[1:-1]}]*{LINE_ENDS}{WS}*", 0))
    far = blank + 80
    return F.struct(
        blank.alias("first"),
        F.when(line > 0, line).otherwise(F.length(text)).alias("line2"),
        (far + F.length(F.regexp_extract(F.substr(text, far + 1), rf"\A{WS}*", 0))).alias("over80"),
        F.length(F.regexp_extract(text, rf"\A{WS}*(?:[^{WS[1:-1]}]+{WS}*){{0,6}}", 0)).alias("words"),
    )


def preamble_is_meaningful(text: Column, bounds: Column, start: Column) -> Column:
    """Whether the text before ``start`` is neither empty nor a header, as ``preamble_is_header`` says."""
    header = (start <= bounds["line2"]) & (start <= bounds["over80"])
    page = F.when(start <= bounds["words"], is_page_line(uni_strip(F.substr(text, F.lit(1), start)))).otherwise(False)
    return (start > bounds["first"]) & ~header & ~page


def candidate_is_safe(strength: Column, number: Column, known: list[str]) -> Column:
    return (strength == "strong") & number.isNotNull() & F.concat(F.lit("Q"), number).isin(known)
