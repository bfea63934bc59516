"""Streaming over a directory of sheets: stateless, one row per file as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from markscribe.config import EngineConfig, Question
from markscribe.plans.pipeline import structure_sheets
from markscribe.sources.sheets import nonblank, sheet_rows


def stream_sheets(spark: SparkSession, directory: str, questions: list[Question], config: EngineConfig = EngineConfig()) -> DataFrame:
    """Structured results of valid, non-blank .txt files as a streaming DataFrame; write it with ``writeStream``."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(directory)
    sheets = nonblank(sheet_rows(files)).selectExpr("student_id as sheet_id", "raw_text")
    return structure_sheets(sheets, questions, config)
