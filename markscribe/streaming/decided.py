"""Sheets and decisions that arrive on streams of their own, in any order.

A sheet is held until as many decisions as its sender expects have arrived for it, then it is
structured as in a batch. What has not come when the time to wait is over counts as unanswered: the
sheet goes on with what there is, and the rest to review. Decisions without a sheet wait as long, then
they are dropped; so state never outlives the wait. Keys are dealt over the state's partitions, and the
state is that of one sheet a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from markscribe.config import EngineConfig, Question
from markscribe.operators.assemble import finish
from markscribe.operators.mapping import decision_map
from markscribe.plans.pipeline import detect, resolve

FIELDS = "operation string, pos int, decision string, question_id string, confidence double, requires_human_review boolean, subject_match boolean"
HELD = f"raw_text string, expected int, decisions array<struct<{FIELDS.replace(' ', ':').replace(',:', ',')}>>"


class Holding(StatefulProcessor):
    """Holds a sheet and its decisions; ``wait`` in milliseconds from the first arrival."""

    def __init__(self, key: str, wait: int):
        self.key, self.wait = key, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        there = self.held.exists()
        text, expected, decisions = tuple(self.held.get()) if there else (None, None, [])
        decisions = [tuple(d) for d in decisions]
        for row in rows:
            if row.is_sheet:
                text, expected = row.raw_text or "", row.expected
            else:
                decisions.append(tuple(row[name.split()[0]] for name in FIELDS.split(", ")))
        if text is not None and len({d[:2] for d in decisions}) >= (expected or 0):
            self.clear()
            yield self.row(key, text, decisions, True)
            return
        self.held.update((text, expected, decisions))
        if not there:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.held.exists():
            text, _, decisions = tuple(self.held.get())
            self.held.clear()
            if text is not None:
                yield self.row(key, text, [tuple(d) for d in decisions], False)

    def clear(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.held.clear()

    def row(self, key: Any, text: str, decisions: list, complete: bool) -> Row:
        return Row(**{self.key: key[0], "raw_text": text, "decisions": decisions, "complete": complete})


def hold(sheets: DataFrame, decisions: DataFrame, wait: int, key: str = "sheet_id") -> DataFrame:
    """Streams ``sheets`` (key, raw_text, expected) and ``decisions`` (key, FIELDS) to rows of key, raw_text, decisions and complete.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    names = [x.split()[0] for x in FIELDS.split(", ")]
    none = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in FIELDS.split(", ")]
    left = sheets.select(key, F.lit(True).alias("is_sheet"), "raw_text", F.col("expected").cast("int").alias("expected"), *none)
    right = decisions.select(key, F.lit(False).alias("is_sheet"), F.lit(None).cast("string").alias("raw_text"), F.lit(None).cast("int").alias("expected"), *names)
    both = left.unionByName(right)
    out = f"{key} {both.schema[key].dataType.simpleString()}, {HELD.replace('expected int, ', '')}, complete boolean"
    return both.groupBy(key).transformWithState(Holding(key, wait), out, "append", "ProcessingTime")


def structure_held(held: DataFrame, questions: list[Question], config: EngineConfig, key: str = "sheet_id") -> DataFrame:
    """Structured results of ``hold``'s rows, as ``structure_sheets`` has them with the same decisions; ``complete`` says whether all had come."""
    df = held.select(key, "raw_text", "complete", *(decision_map(F.col("decisions"), o).alias(f"{o}_decisions") for o in ("boundary", "mapping")))
    return finish(resolve(detect(df), questions, config, key=key, maps=("boundary_decisions", "mapping_decisions")), questions, config)
