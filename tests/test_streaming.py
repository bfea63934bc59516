"""Sheets and decisions on streams, in any order, against the batch."""

import contextlib
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.plans.pipeline import structure_sheets
from markscribe.streaming.decided import FIELDS, hold, structure_held

QUESTIONS = [Question(n) for n in (1, 2, 4)]
ON = EngineConfig(adjudicate=True)
SHEETS = [(1, "Q1 a\n4) odd\nQ2 b", 4), (2, "Q1 x\nQ1 y", 2), (3, "nothing", 1), (4, "", 0)]
DECISIONS = [
    (1, "boundary", 2, "question_boundary", "Q4", 0.9, False, None), (1, "mapping", 1, "mapped", "Q1", 0.9, False, True),
    (1, "mapping", 2, "mapped", "Q4", 0.9, False, True), (1, "mapping", 3, "mapped", "Q2", 0.9, False, True),
    (2, "mapping", 1, "mapped", "Q1", 0.95, False, True), (2, "mapping", 2, "unmapped", None, 0.9, False, None), (3, "mapping", 1, "mapped", "Q2", 0.5, False, True),
]
OF_SHEETS, OF_DECISIONS = "sheet_id long, raw_text string, expected int", f"sheet_id long, {FIELDS}"


@pytest.fixture()
def stream(spark, tmp_path):
    """Feeds both streams, and runs the query over what has come; results gather in a folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    places = {n: str(tmp_path / n) for n in ("sheets", "decisions", "out", "at")}

    def feed(sheets=(), decisions=()):
        for rows, schema, name in ((sheets, OF_SHEETS, "sheets"), (decisions, OF_DECISIONS, "decisions")):
            spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(places[name])

    def run(until, wait=3_600_000):
        left, right = (spark.readStream.schema(s).parquet(places[n]) for s, n in ((OF_SHEETS, "sheets"), (OF_DECISIONS, "decisions")))
        results = structure_held(hold(left, right, wait), QUESTIONS, ON).select("sheet_id", "complete", F.to_json("questions").alias("q"), F.to_json("review").alias("r"), F.to_json("unmapped").alias("u"))
        query = results.writeStream.format("parquet").option("path", places["out"]).option("checkpointLocation", places["at"]).trigger(processingTime="1 second").start()
        found, last = {}, time.time() + 120
        while set(found) != until and time.time() < last and query.isActive:  # timers alone may start batches, so the query never runs out of work
            time.sleep(1)
            with contextlib.suppress(AnalysisException):  # nothing written yet
                found = {r.sheet_id: (r.q, r.r, r.u, r.complete) for r in spark.read.schema("sheet_id long, q string, r string, u string, complete boolean").parquet(places["out"]).collect()}
        query.stop()
        return found

    return feed, run


def batch(spark, decisions=DECISIONS, sheets=SHEETS):
    rows = structure_sheets(spark.createDataFrame(sheets, OF_SHEETS), QUESTIONS, ON, spark.createDataFrame(decisions, OF_DECISIONS))
    return {r.sheet_id: (r.q, r.r, r.u) for r in rows.select("sheet_id", F.to_json("questions").alias("q"), F.to_json("review").alias("r"), F.to_json("unmapped").alias("u")).collect()}


def test_decisions_out_of_order_give_the_batch_result(spark, stream):
    feed, run = stream
    mixed = random.Random(1).sample(DECISIONS, len(DECISIONS))
    feed(SHEETS[1:], mixed[:4])  # some decisions before their sheet
    now = {s[0] for s in SHEETS[1:] if s[2] <= sum(d[0] == s[0] for d in mixed[:4])}
    assert set(run(now)) == now
    feed(SHEETS[:1], [*mixed[4:], mixed[0]])  # and one of them twice
    done = run({1, 2, 3, 4})
    assert {k: v[:3] for k, v in done.items()} == batch(spark) and all(v[3] for v in done.values())


def test_sheets_go_to_review_when_the_wait_is_over(spark, stream):
    feed, run = stream
    feed(SHEETS[:1], [DECISIONS[1], DECISIONS[4]])
    done = run({1}, wait=1000)
    assert done == {1: (*batch(spark, [DECISIONS[1]])[1], False)}  # and the decision without a sheet is dropped
