"""Adjudicator replies: JSON parsing, coercion, validation and the acceptance gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.functions.text import WS, uni_strip

# Decision vocabularies.
VOCABULARY = {"boundary": ("question_boundary", "continuation"), "mapping": ("mapped", "unmapped", "ambiguous")}
_NUMBER = r"\A[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+)?\z"
_SPECIAL = r"(?i)\A[+-]?(?:inf|infinity|nan)\z"


def _field(v: Column, name: str) -> Column:
    """A reply's field as text with its JSON kind."""
    return F.struct(F.try_variant_get(v, f"$.{name}", "string").alias("s"), F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")).alias("k"))


def _is_number(k: Column) -> Column:
    return k.rlike("(?i)^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|SMALLINT|TINYINT)")


def coerce_bool(x: Column) -> Column:
    """True or false of a JSON boolean, 0 or 1, or their strings; else null."""
    low = F.lower(uni_strip(x["s"]))
    number = x["s"].try_cast("double")
    return (
        F.when(F.upper(x["k"]) == "BOOLEAN", low == "true")
        .when(_is_number(x["k"]) & number.isin(0.0, 1.0), number == 1)
        .when((F.upper(x["k"]) == "STRING") & low.isin("true", "1"), True)
        .when((F.upper(x["k"]) == "STRING") & low.isin("false", "0"), False)
    )


def coerce_number(x: Column) -> Column:
    """The number of a JSON number or numeric string; booleans and the rest are null."""
    s = uni_strip(x["s"])
    plain = F.regexp_replace(s, "_", "").try_cast("double")
    special = F.when(F.lower(s).contains("nan"), float("nan")).when(s.startswith("-"), float("-inf")).otherwise(float("inf"))
    text = F.when(s.rlike(_NUMBER), plain).when(s.rlike(_SPECIAL), special)
    return F.when(_is_number(x["k"]), x["s"].try_cast("double")).when(F.upper(x["k"]) == "STRING", text)


def parse_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Add decision, question_id, confidence, requires_human_review, subject_match, parsed.

    A code fence is dropped; if the rest is not one JSON value from end to end, the first flat object
    with a decision counts; what cannot be parsed is an ambiguous decision for review. A decision or a
    confidence that is null in the reply is null here; only a field that is not there has a default.
    """
    bare = uni_strip(F.col(reply))
    bare = F.when(bare.startswith("```"), uni_strip(F.regexp_replace(bare, rf"(?is)\A```(?:json)?{WS}*|{WS}*```\z", ""))).otherwise(bare)
    # the parser stops after a value and ignores the rest, so a reply is read as the first of a list that must end with its own last element
    listed = F.try_parse_json(F.concat(F.lit("["), bare, F.lit(',"end"]')))
    alone = (F.try_variant_get(listed, "$[1]", "string") == "end") & F.try_variant_get(listed, "$[2]", "variant").isNull()
    whole = F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))
    inner = F.filter(F.regexp_extract_all(bare, F.lit(r"(?s)\{.*?\}"), F.lit(0)), lambda o: F.try_variant_get(F.try_parse_json(o), "$.decision", "variant").isNotNull())
    df = df.withColumn("_v", F.when(whole.isNotNull(), whole).otherwise(F.try_parse_json(F.get(inner, F.lit(0)))))
    names = ("decision", "question_id", "confidence", "requires_human_review", "needs_human_review", "subject_match", "subject_compat")
    df = df.withColumn("parsed", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    df = df.withColumns({f"_{n}": _field(F.col("_v"), n) for n in names})
    given = lambda n: F.col(f"_{n}")["s"].isNotNull()
    there = lambda n: F.col(f"_{n}")["k"].isNotNull()
    review = F.when(given("requires_human_review"), coerce_bool(F.col("_requires_human_review"))).when(there("needs_human_review"), coerce_bool(F.col("_needs_human_review"))).otherwise(False)
    out = {
        "decision": F.when(F.col("parsed") & there("decision"), F.col("_decision")["s"]).otherwise("ambiguous"),
        "question_id": F.col("_question_id")["s"],
        "confidence": F.when(F.col("parsed") & there("confidence"), coerce_number(F.col("_confidence"))).otherwise(0.0),
        "requires_human_review": F.when(~F.col("parsed"), True).otherwise(review),
        "subject_match": F.when(given("subject_match"), coerce_bool(F.col("_subject_match"))).otherwise(coerce_bool(F.col("_subject_compat"))),
    }
    return df.select(*(c for c in df.columns if not c.startswith("_")), *(v.alias(k) for k, v in out.items()))


def normalize_question_id(value: Column, known: list[str]) -> Column:
    number = F.regexp_extract(F.upper(uni_strip(value)), rf"\AQ?{WS}*(\d+)\.?\z", 1)
    found = F.concat(F.lit("Q"), number.try_cast("bigint"))
    return F.when(found.isin(known), found)


def validate(df: DataFrame, known: list[str], operation: str) -> DataFrame:
    """The ordered validation rules, on columns of those names."""
    c = F.col
    number = c("confidence").isNotNull()
    d1 = F.when(c("decision").isin(*VOCABULARY[operation]), c("decision")).otherwise("ambiguous")
    q1 = normalize_question_id(c("question_id"), known)
    forced = ~number | ~F.coalesce(c("decision").isin(*VOCABULARY[operation]), F.lit(False)) | (c("question_id").isNotNull() & q1.isNull())
    mismatch = (d1 == "mapped") & F.coalesce(~c("subject_match"), F.lit(False))
    d2 = F.when(mismatch, "ambiguous").otherwise(d1)
    review = forced | F.coalesce(c("requires_human_review"), F.lit(False)) | (d1.isin("question_boundary", "mapped") & q1.isNull()) | mismatch | (d2 == "ambiguous")
    clamped = F.when(number, F.greatest(F.lit(0.0), F.least(F.lit(1.0), c("confidence")))).otherwise(0.0)
    new = {"decision": d2, "question_id": q1, "confidence": clamped, "requires_human_review": review}
    return df.select(*(new[x].alias(x) if x in new else c(x) for x in df.columns))


def gate(threshold: float) -> Column:
    """A mapping that is accepted: mapped, with an id, a matching subject, enough confidence, no review."""
    ok = (F.col("decision") == "mapped") & F.col("question_id").isNotNull() & F.col("subject_match") & (F.col("confidence") >= threshold) & ~F.col("requires_human_review")
    return F.coalesce(ok, F.lit(False))
