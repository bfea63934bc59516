"""Cutting a document into answer blocks at accepted markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.functions.folds import let, pieces, span
from markscribe.functions.text import once, uni_strip
from markscribe.operators.markers import is_page_line

BLOCK = "struct<text:string,source_start:int,source_end:int,detected_marker:string,resolved_question_id:string,confidence:double,status:string,source_order:int>"


def _block(text: Column, start: Column, end: Column, marker: Column) -> Column:
    return F.struct(
        text.alias("text"), start.cast("int").alias("source_start"), end.cast("int").alias("source_end"), marker.alias("detected_marker"),
        F.lit(None).cast("string").alias("resolved_question_id"), F.lit(0.0).alias("confidence"), F.lit("needs_mapping").alias("status"), F.lit(0).alias("source_order"),
    )


def cut_blocks(text: Column, accepted: Column, cut: Column) -> Column:
    """array<BLOCK> of a text and its ``pieces``: prefix or whole document, then each marker's answer; empty answers give none."""
    none, length = F.lit(None).cast("string"), F.length(text)
    first = F.get(accepted, F.lit(0))["start"]
    prefix = uni_strip(span(cut, F.lit(0), first))
    head = F.when((F.size(accepted) == 0) & (text != ""), F.array(_block(text, F.lit(0), length, none)))
    head = head.when((first > 0) & (prefix != "") & ~is_page_line(prefix), F.array(_block(prefix, F.lit(0), first, none))).otherwise(F.array().cast(f"array<{BLOCK}>"))

    def answer(c: Column, i: Column) -> Column:
        end = F.coalesce(F.get(accepted, i + 1)["start"], length)
        return _block(uni_strip(span(cut, c["end"], end - c["end"])), c["end"], end, c["marker"])

    blocks = F.concat(head, F.filter(F.transform(accepted, answer), lambda b: b["text"] != ""))
    return let(blocks, lambda bs: F.transform(bs, lambda b, i: b.withField("source_order", (i + 1).cast("int"))))


def with_blocks(df: DataFrame, questions: bool, text: str = "normalized") -> DataFrame:
    """Add ``blocks`` and ``structureless`` (several candidates but one unmarked block)."""
    df = df.withColumn("_cut", once(pieces(F.col(text))))
    df = df.withColumn("blocks", once(cut_blocks(F.col(text), F.col("accepted"), F.col("_cut")))).drop("_cut")
    alone = (F.size("candidates") > 1) & (F.size("blocks") == 1) & F.get("blocks", F.lit(0))["detected_marker"].isNull()
    return df.withColumn("structureless", F.lit(questions) & F.coalesce(alone, F.lit(False)))
