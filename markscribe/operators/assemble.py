"""Merging adjacent blocks, answers per question, unmapped and review rows, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.functions.folds import distinct_in_order, let, pieces, runs, span
from markscribe.functions.text import once, uni_strip
from markscribe.operators.classify import REVIEW
from markscribe.operators.mapping import ordered_ids
from markscribe.operators.markers import STRONG


def merge_adjacent(cut: Column, blocks: Column) -> Column:
    """Merge a block into its predecessor if both resolve to one question and only its own weak marker lies between; ``cut`` are the text's ``pieces``.

    A merged block ends where its last one does, so each block is held against the one before it alone.
    """

    def apart(bs: Column, i: Column) -> Column:
        b, last = F.get(bs, i), F.get(bs, i - 1)
        gap = uni_strip(span(cut, last["source_end"], b["source_start"] - last["source_end"]))
        marker = F.coalesce(b["detected_marker"], F.lit(""))
        same = (last["resolved_question_id"] == b["resolved_question_id"]) & (gap != "") & (gap == uni_strip(marker)) & ~marker.rlike(STRONG)
        return ~F.coalesce(same, F.lit(False)) | (i == 0)

    def joined(bs: Column, r: Column) -> Column:
        first, last = F.get(bs, r["first"]), F.get(bs, r["last"])
        sure = F.array_max(F.transform(F.slice(bs, r["first"] + 1, r["last"] - r["first"] + 1), lambda b: b["confidence"]))
        text = span(cut, first["source_start"], last["source_end"] - first["source_start"])
        return F.when(r["first"] == r["last"], first).otherwise(first.withField("text", text).withField("source_end", last["source_end"]).withField("confidence", sure))

    return let(blocks, lambda bs: F.transform(runs(F.size(bs), lambda i: apart(bs, i)), lambda r: joined(bs, r)))


def finish(df: DataFrame, questions: list[Question], config: EngineConfig, text: str = "normalized") -> DataFrame:
    """Merge, then add ``questions``, ``unmapped``, ``review`` and ``audit``."""
    ids = ordered_ids(questions)
    known = F.array(*(F.lit(i) for i in ids)).cast("array<string>")
    df = df.withColumn("_cut", once(pieces(F.col(text))))
    df = df.withColumn("blocks", once(merge_adjacent(F.col("_cut"), F.col("blocks")))).drop("_cut")
    only = F.get("blocks", F.lit(0))
    alone = F.lit(bool(ids)) & (F.size("candidates") > 1) & (F.size("blocks") == 1) & ((only["status"] == "unmapped") | only["resolved_question_id"].isNull())
    df = df.withColumn("_alone", F.coalesce(alone, F.lit(False)))
    drop = lambda b: b.withField("status", F.lit("unmapped")).withField("resolved_question_id", F.lit(None).cast("string"))
    df = df.withColumn("blocks", once(F.when(F.col("_alone"), F.transform("blocks", drop)).otherwise(F.col("blocks"))))
    nothing = (F.size("blocks") == 0) & (uni_strip(F.col(text)) != "")
    lost = nothing & (F.lit(bool(ids)) if config.adjudicate else F.lit(True))
    items = F.array().cast(f"array<{REVIEW}>")
    item = lambda t: F.array(F.struct(t.alias("text"), known.alias("possible_questions")))
    extra = F.concat(F.when(F.col("_alone"), item(F.get("blocks", F.lit(0))["text"])).otherwise(items), F.when(nothing & F.lit(not config.adjudicate), item(F.col(text))).otherwise(items))
    raw = F.concat("boundary_review", "mapping_review", extra)
    review = distinct_in_order(F.filter(F.transform(raw, lambda r: F.struct(uni_strip(r["text"]).alias("text"), F.array_sort(r["possible_questions"]).alias("possible_questions"))), lambda r: r["text"] != ""))

    def answers(q: str) -> Column:
        own = F.filter("blocks", lambda b: b["resolved_question_id"] == q)
        return F.struct(F.lit(q).alias("question_id"), F.transform(own, lambda b: b["text"]).alias("answers"))

    per_question = [answers(q) for q in ids]
    out = F.array(*per_question) if ids else F.array().cast("array<struct<question_id:string,answers:array<string>>>")
    texts = F.transform(F.filter("blocks", lambda b: b["status"] == "unmapped"), lambda b: b["text"])
    whole = F.when(lost, F.array(F.col(text))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("questions", once(out)).withColumn("unmapped", once(F.array_distinct(F.concat(whole, texts)))).withColumn("review", once(review))
    audit = F.struct(
        (F.col("boundary_calls") + F.col("mapping_calls")).alias("calls"), "boundary_calls", "mapping_calls",
        F.lit(config.model).alias("model"), F.lit(config.device).alias("device"), F.lit(config.compute_dtype).alias("dtype"), F.lit(config.quantization).alias("quantization"),
        (F.col("duration_ms") if "duration_ms" in df.columns else F.lit(0)).cast("long").alias("duration_ms"), F.lit(config.exam_id).alias("exam_id"), F.size("candidates").alias("candidate_count"), F.size("accepted").alias("accepted_count"),
        F.size("blocks").alias("block_count"), F.size("review").alias("review_count"), F.size("unmapped").alias("unmapped_count"),
    )
    return df.withColumn("audit", audit).drop("_alone")


def with_accessors(df: DataFrame, key: str = "sheet_id") -> DataFrame:
    """Add the result's other names: student_id, review_items, unmapped_content, and processing_status (always success)."""
    return df.withColumns({"student_id": F.col(key).cast("string"), "review_items": F.col("review"), "unmapped_content": F.col("unmapped"), "processing_status": F.lit("success")})


def minimal_json(key: Column) -> Column:
    answers = F.flatten(F.transform("questions", lambda q: F.transform(q["answers"], lambda a: F.struct(q["question_id"].alias("question_id"), a.alias("answer")))))
    unmapped = F.transform("unmapped", lambda t: F.struct(t.alias("text")))
    return F.to_json(F.struct(key.cast("string").alias("student_id"), F.col("audit.exam_id").alias("exam_id"), answers.alias("answers"), unmapped.alias("unmapped_content")))


def debug_json(key: Column, raw: str, text: str = "normalized") -> Column:
    """All parts; a question's value is null, a string or a list."""
    value = lambda a: F.when(F.size(a) == 0, F.lit("null")).when(F.size(a) == 1, F.get(F.transform(a, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)\A\[(.*)\]\z", 1)), F.lit(0))).otherwise(F.to_json(a))
    name = lambda s: F.regexp_extract(F.to_json(F.array(s)), r"(?s)\A\[(.*)\]\z", 1)
    qs = F.concat(F.lit("{"), F.array_join(F.transform("questions", lambda q: F.concat(name(q["question_id"]), F.lit(":"), value(q["answers"]))), ","), F.lit("}"))
    rest = F.to_json(F.struct(F.col("review"), F.col("unmapped"), F.col("audit"), F.col(raw).alias("processed_text"), F.col(text).alias("normalized_text")), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"student":'), name(key.cast("string")), F.lit(',"questions":'), qs, F.lit(","), F.substr(rest, F.lit(2)))
