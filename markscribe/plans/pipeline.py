"""The whole engine: sheets to structured results, one row per document.

Without decisions nothing is shuffled; decisions are grouped by document and joined to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.functions.text import normalize_text, once
from markscribe.operators.assemble import finish
from markscribe.operators.blocks import with_blocks
from markscribe.operators.classify import accept
from markscribe.operators.mapping import decision_maps, map_blocks
from markscribe.operators.markers import detect_candidates


def detect(sheets: DataFrame, text: str = "raw_text") -> DataFrame:
    """``sheets`` with ``normalized`` and ``candidates``."""
    return sheets.withColumn("normalized", once(normalize_text(F.col(text)))).withColumn("candidates", once(detect_candidates(F.col("normalized"))))


def resolve(detected: DataFrame, questions: list[Question], config: EngineConfig, decisions: DataFrame | None = None, key: str = "sheet_id", maps: tuple = (None, None)) -> DataFrame:
    """Fold, blocks and mapping of ``detect``'s rows; ``maps`` names columns that hold their decisions already."""
    df = detected
    if decisions is not None:
        df, maps = df.join(decision_maps(decisions, key), key, "left"), ("boundary_decisions", "mapping_decisions")
    df = accept(df, questions, config, decisions=maps[0])
    return map_blocks(with_blocks(df, bool(questions)), questions, config, decisions=maps[1])


def structure_sheets(sheets: DataFrame, questions: list[Question], config: EngineConfig = EngineConfig(), decisions: DataFrame | None = None, key: str = "sheet_id", text: str = "raw_text") -> DataFrame:
    """Add candidates, accepted, blocks, questions, unmapped, review and audit.

    ``decisions(key, operation, pos, decision, question_id, confidence, requires_human_review,
    subject_match)`` holds validated replies; they join as one row of maps per document.
    """
    return finish(resolve(detect(sheets, text), questions, config, decisions, key), questions, config)
