"""The legacy segmenter: markers with inferred numbers, prompt stripping, answers merged by question."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from markscribe.functions.folds import let, pieces, runs, scan, span
from markscribe.functions.text import ND, WS, integer_in, match_spans, uni_strip

# The legacy marker grammar and prompt verbs.
_NUMBER = rf"[1-9]{ND}*"
_STEM = rf"Q(?:UESTION)?{WS}*(?:NO\.?|N)?{WS}*"
MARKER = rf"(?iu)(?<![A-Za-z0-9])(?:{_STEM}(?:{_NUMBER}|[IL]|[.:-])?(?={WS}|\z|[.!?,;:)(\]])|{_NUMBER}{WS}*[):.-](?={WS}|\z))"
_LEAD = rf"(?:In{WS}+your{WS}+own{WS}+words,{WS}*)?"
_VERBS = rf"(?:Explain|Describe|Define|State|List|What{WS}+is|What{WS}+are|Why|How|When|Where|Who|Which)"
PROMPT = rf"(?iu)\A{_LEAD}{_VERBS}\b[^\n]*?[.!?](?={WS}|\z)"
ASKS = rf"(?iu)\A{_LEAD}{_VERBS}\b"


def strip_prompt(text: Column) -> Column:
    """Drop a leading prompt sentence unless nothing would remain."""
    t = uni_strip(text)
    rest = uni_strip(F.regexp_replace(t, PROMPT, ""))
    return F.when(t.rlike(PROMPT) & (rest != ""), rest).otherwise(t)


def clean_answer(text: Column, same_line: Column) -> Column:
    t = uni_strip(text)
    t = F.when(same_line & t.rlike(ASKS), strip_prompt(t)).otherwise(t)
    return uni_strip(F.regexp_replace(t, f"{WS}+", " "))


def normalize_label(value: Column) -> Column:
    """Q and number; a lone I or L reads as Q1."""
    t = F.translate(F.upper(uni_strip(F.coalesce(value, F.lit("")))), ".-", "")
    return F.when(t.isin("I", "L", "QI", "QL"), "Q1").when(t.rlike(rf"\A{ND}+\z"), F.concat(F.lit("Q"), t)).otherwise(t)


def extract_question(line: Column) -> Column:
    """struct<question, rest> of a line's first marker: its label (I and L read as Q1, a bare stem as Q) and what follows without a prompt; nulls and empty without one."""
    t = uni_strip(F.coalesce(line, F.lit("")))

    def found(m: Column) -> Column:
        number = F.upper(F.regexp_extract(m["text"], rf"(?iu)({_NUMBER})", 1))
        roman = F.upper(F.regexp_extract(m["text"], rf"(?iu)\A{_STEM}([IL])\z", 1))
        label = normalize_label(F.concat(F.lit("Q"), F.when(number != "", number).otherwise(roman)))
        return F.struct(label.alias("question"), strip_prompt(F.substr(t, m["end"] + 1)).alias("rest"))

    none = F.struct(F.lit(None).cast("string").alias("question"), F.lit("").alias("rest"))
    return let(F.get(match_spans(t, MARKER), F.lit(0)), lambda m: F.when(m.isNull(), none).otherwise(found(m)))


def is_question_line(line: Column) -> Column:
    return extract_question(line)["question"].isNotNull()


class QuestionDetector(Protocol):
    """How question lines are told: ``detect`` gives struct<question, rest> of a line."""

    def detect(self, line: Column) -> Column: ...


class PatternDetector:
    """The detector by the legacy grammar."""

    def detect(self, line: Column) -> Column:
        return extract_question(line)


def question_marks(text: Column) -> Column:
    """array<struct<start, end, question>>: numbers set a counter, I, L and bare marks raise it, a bare stem is none."""
    spans = F.transform(
        match_spans(text, MARKER),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"),
            integer_in(F.regexp_extract(m["text"], rf"(?iu)({_NUMBER})", 1)).alias("number"),
            m["text"].rlike(rf"(?iu)\A{_STEM}(?:[IL]|[.:-])\z").alias("next"),
        ),
    )

    def step(at: Column, m: Column) -> Column:
        n = F.when(m["number"].isNotNull(), m["number"]).when(m["next"], at + 1)
        item = F.struct(m["start"].alias("start"), m["end"].alias("end"), F.concat(F.lit("Q"), n).alias("question"))
        return F.struct(F.coalesce(n, at).alias("state"), item.alias("out"))

    numbered = scan(spans, F.lit(0).cast("bigint"), step, "struct<start:int,end:int,question:string>")
    return F.filter(numbered, lambda m: m["question"].isNotNull())


def segment(text: Column) -> Column:
    """array<struct<question, answer>> of a normalised text, in first-seen order; UNKNOWN without markers.

    ``text`` must be a plain column (lambdas refer to it).
    """
    pair = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))

    def answers(marks: Column, cut: Column) -> Column:
        def each(m: Column, i: Column) -> Column:
            end = F.coalesce(F.get(marks, i + 1)["start"], F.length(text))
            same_line = ~F.contains(span(cut, m["start"], m["end"] - m["start"] + 1), F.lit("\n"))
            return pair(m["question"], clean_answer(span(cut, m["end"], end - m["end"]), same_line))

        return F.filter(F.transform(marks, each), lambda x: x["answer"] != "")

    def merged(found: Column) -> Column:
        def grouped(s: Column) -> Column:
            own = lambda r: F.transform(F.slice(s, r["first"] + 1, r["last"] - r["first"] + 1), lambda x: x["answer"])
            each = runs(F.size(s), lambda i: (i == 0) | (F.get(s, i)["question"] != F.get(s, i - 1)["question"]))
            first = F.transform(each, lambda r: F.struct(F.get(s, r["first"])["i"].alias("i"), F.get(s, r["first"])["question"].alias("question"), F.array_join(own(r), " ").alias("answer")))
            return F.transform(F.array_sort(first), lambda x: pair(x["question"], x["answer"]))

        return let(F.array_sort(F.transform(found, lambda x, i: F.struct(x["question"].alias("question"), i.alias("i"), x["answer"].alias("answer")))), grouped)

    unknown = lambda a: F.array(pair(F.lit("UNKNOWN"), a))
    some = let(question_marks(text), lambda marks: F.when(F.size(marks) == 0, unknown(uni_strip(F.regexp_replace(text, f"{WS}+", " ")))).otherwise(
        let(let(pieces(text), lambda cut: answers(marks, cut)), lambda found: F.when(F.size(found) == 0, unknown(text)).otherwise(merged(found)))))
    return F.when(F.coalesce(text, F.lit("")) == "", unknown(F.lit("Entire OCR Text"))).otherwise(some)
