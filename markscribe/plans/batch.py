"""A batch: a folder of sheets and a file of model answers to one JSON file per student, with a log."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markscribe.config import EngineConfig
from markscribe.operators.assemble import debug_json, minimal_json
from markscribe.plans.adjudicate import Adjudicator, adjudicate, structure_decided
from markscribe.plans.pipeline import structure_sheets
from markscribe.sources.canon import read_questions
from markscribe.sources.sheets import file_names, scan_sheets, write_student_files


def configure_log(directory: str) -> logging.Logger:
    """The driver's log, to ``markscribe.log`` and standard error; handlers are added once."""
    os.makedirs(directory, exist_ok=True)
    log = logging.getLogger("markscribe")
    log.setLevel(logging.INFO)
    log.propagate = False
    if not log.handlers:
        to_file = logging.FileHandler(os.path.join(directory, "markscribe.log"), encoding="utf-8")
        to_file.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s"))
        log.addHandler(to_file)
        log.addHandler(logging.StreamHandler())
    return log


@dataclass
class BatchResult:
    """``results``: one row per sheet (student_id, path, ...); ``unreadable``: path, error; ``calls`` and ``failures`` as the adjudication has them."""

    results: DataFrame
    unreadable: DataFrame
    calls: dict[str, int] = field(default_factory=dict)
    failures: DataFrame | None = None


def run_batch(spark: SparkSession, config: EngineConfig, adjudicator: Adjudicator | None = None) -> BatchResult:
    """Structure every sheet of ``config.input_dir`` and write its files; malformed sheets and failed calls are logged and passed over."""
    log = configure_log(config.logs_dir)
    questions = read_questions(spark, config.model_answers_path)
    sheets, errors = scan_sheets(spark, config.input_dir)
    for row in errors.orderBy("path").toLocalIterator():
        log.error("skipped: %s: %s", row.path, row.error)
    out = BatchResult(sheets, errors)
    if adjudicator and config.adjudicate and questions:
        asked = adjudicate(sheets, questions, config, adjudicator, key="path")
        out.calls, out.failures = asked.calls, asked.failures
        for row in asked.failures.orderBy("path", "operation", "pos").toLocalIterator():
            log.error("failed call: %s, %s %d: %s", row.path, row.operation, row.pos, row.error)
        results = structure_decided(sheets, questions, config, asked.decisions, "path", "raw_text")
    else:
        results = structure_sheets(sheets, questions, config, key="path")
    out.results = file_names(results)
    files = out.results.select("file_name", minimal_json(F.col("student_id")).alias("minimal"), debug_json(F.col("student_id"), "raw_text").alias("debug"))
    write_student_files(files, config.output_dir)
    log.info("written to %s with %d questions; calls: %s", config.output_dir, len(questions), out.calls)
    return out
