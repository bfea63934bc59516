"""Blocks of very long sheets as rows: the same cut and merge as over arrays, by windows and joins.

The array form keeps a sheet in one row; choose this one where candidates and text of a sheet would
not fit there. Markers, blocks and the text's pieces are rows; windows run over a sheet's markers
(lead, lag and running sums, a row at a time), and a block's text is put together from the pieces it
lies on, so that no task holds more than one block's text at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markscribe.functions.folds import PIECE, pieces
from markscribe.functions.text import uni_strip
from markscribe.operators.markers import STRONG, is_page_line


def piece_rows(df: DataFrame, key: str = "sheet_id", text: str = "normalized") -> DataFrame:
    """key, piece, part: a text's pieces in order."""
    return df.select(key, F.posexplode(pieces(F.col(text))).alias("piece", "part"))


def span_texts(spans: DataFrame, parts: DataFrame, start: str, end: str, out: str, key: str = "sheet_id") -> DataFrame:
    """``spans`` (key, start and end code points; distinct per key) with the text between, empty where nothing is."""
    on = F.sequence(F.expr(f"{start} div {PIECE}"), F.expr(f"({end} - 1) div {PIECE}"))
    needed = spans.filter(F.col(start) < F.col(end)).select(key, start, end, F.explode(on.cast("array<int>")).alias("piece"))
    found = needed.join(parts, [key, "piece"]).groupBy(key, start, end).agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("_parts"))
    text = F.substr(F.array_join(F.transform("_parts", lambda p: p["part"]), ""), F.col(start) % PIECE + 1, F.col(end) - F.col(start))
    return spans.join(found.select(key, start, end, text.alias(out)), [key, start, end], "left").withColumn(out, F.coalesce(out, F.lit("")))


def cut_rows(accepted: DataFrame, parts: DataFrame, key: str = "sheet_id") -> DataFrame:
    """key, source_order, detected_marker, source_start, source_end, text: ``cut_blocks`` over ``accepted`` (key, marker, start, end) and ``piece_rows``."""
    lengths = parts.groupBy(key).agg(F.sum(F.length("part")).cast("int").alias("n"))
    by = Window.partitionBy(key).orderBy("start")
    own = accepted.join(lengths, key).select(key, F.col("marker").alias("detected_marker"), F.col("end").alias("source_start"), F.coalesce(F.lead("start").over(by), F.col("n")).alias("source_end"), F.lit("answer").alias("kind"))
    first = accepted.groupBy(key).agg(F.min("start").alias("first"))
    head = lengths.join(first, key, "left").filter("first is null or first > 0")
    head = head.select(key, F.lit(None).cast("string").alias("detected_marker"), F.lit(0).alias("source_start"), F.coalesce("first", "n").alias("source_end"), F.when(F.col("first").isNull(), "whole").otherwise("prefix").alias("kind"))
    spans = span_texts(own.unionByName(head), parts, "source_start", "source_end", "text", key)
    spans = spans.withColumn("text", F.when(F.col("kind") == "whole", F.col("text")).otherwise(uni_strip(F.col("text"))))
    kept = spans.filter((F.col("text") != "") & ((F.col("kind") != "prefix") | ~is_page_line(F.col("text"))))
    order = F.row_number().over(Window.partitionBy(key).orderBy("source_start", "source_end"))
    return kept.select(key, order.alias("source_order"), "detected_marker", "source_start", "source_end", "text")


def merge_rows(blocks: DataFrame, parts: DataFrame, key: str = "sheet_id") -> DataFrame:
    """``merge_adjacent`` over rows (key, source_order, detected_marker, resolved_question_id, confidence, status, source_start, source_end, text)."""
    by = Window.partitionBy(key).orderBy("source_order")
    last = lambda c: F.lag(c).over(by)
    same_id: Column = F.coalesce(last("resolved_question_id") == F.col("resolved_question_id"), F.lit(False))
    rows = blocks.withColumn("_from", F.when(same_id & ~F.coalesce("detected_marker", F.lit("")).rlike(STRONG), last("source_end")))
    gaps = span_texts(rows.filter("_from is not null").select(key, "_from", "source_start"), parts, "_from", "source_start", "_gap", key)
    rows = rows.join(gaps.withColumn("_gap", uni_strip(F.col("_gap"))), [key, "_from", "source_start"], "left")
    joins = F.coalesce((F.col("_gap") != "") & (F.col("_gap") == uni_strip(F.coalesce("detected_marker", F.lit("")))), F.lit(False))
    rows = rows.withColumn("_island", F.sum((~joins).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    of_first = [F.min_by(c, "source_order").alias(c) for c in ("detected_marker", "resolved_question_id", "status", "text")]
    merged = rows.groupBy(key, "_island").agg(
        F.min("source_order").alias("source_order"), F.min("source_start").alias("source_start"), F.max("source_end").alias("source_end"), F.max("confidence").alias("confidence"), F.count("*").alias("_n"), *of_first
    )
    longer = span_texts(merged.filter("_n > 1").select(key, "source_start", "source_end"), parts, "source_start", "source_end", "_whole", key)
    merged = merged.join(longer, [key, "source_start", "source_end"], "left").withColumn("text", F.coalesce("_whole", "text"))
    return merged.select(key, "source_order", "detected_marker", "resolved_question_id", "confidence", "status", "source_start", "source_end", "text")
