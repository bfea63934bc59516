"""Adjudication by a callable: the questions that the fold and the mapping really ask, in rounds.

A round resolves the active documents with the decisions known so far and takes from each the first
question that has none: what later questions are, and whether they are asked at all, may hang on it.
Documents that ask nothing leave, so the active set only shrinks. Equal prompts are put to the
adjudicator once and joined back; a memo that lasts keeps replies for later batches. Every step is a
written table, so it survives lost executors, and tables of ended rounds are deleted.
"""

from __future__ import annotations

import json
import re
import time
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.operators.decisions import parse_replies, validate
from markscribe.operators.mapping import boundary_contexts, boundary_prompt, mapping_contexts, mapping_prompt, ordered_ids
from markscribe.plans.pipeline import detect, resolve, structure_sheets
from markscribe.plans.scratch import Scratch

FIELDS = "operation string, pos int, decision string, question_id string, confidence double, requires_human_review boolean, subject_match boolean, duration_ms long, error string"
MEMO = "prompt_id string, reply string, duration_ms long, calls int, error string"
# The least tokens of a mapping reply, and the range of a retry's.
MAPPING_TOKENS, RETRY_TOKENS = 96, (192, 256)


class Adjudicator(Protocol):
    """Anything that answers a prompt with at most this many tokens; it is pickled to the workers."""

    def __call__(self, prompt: str, new_tokens: int) -> str: ...


def is_reply(text: str | None) -> bool:
    """Whether a reply can be parsed: JSON, in a fence or not, or a flat object with a decision."""
    bare = re.sub(r"(?is)^```(?:json)?\s*|\s*```$", "", (text or "").strip())
    for part in [bare, *re.findall(r"(?s)\{.*?\}", bare)]:
        try:
            value = json.loads(part)
        except ValueError:
            continue
        if part is bare or (isinstance(value, dict) and "decision" in value):
            return True
    return False


def replies(prompts: DataFrame, adjudicator: Adjudicator, config: EngineConfig) -> DataFrame:
    """MEMO rows of ``prompts(prompt_id, prompt, operation)``: an unparsable reply is asked for once more, with more tokens; a failure has no reply but its reason."""

    def ask(prompt: str, operation: str) -> tuple[str | None, int, str | None]:
        tokens, calls = max(config.max_new_tokens, MAPPING_TOKENS) if operation == "mapping" else config.max_new_tokens, 1
        try:
            reply = adjudicator(prompt, tokens)
            if not is_reply(reply):
                calls, reply = 2, adjudicator(prompt, min(max(2 * config.max_new_tokens, RETRY_TOKENS[0]), RETRY_TOKENS[1]))
            return reply, calls, None
        except Exception as e:  # a failure is an answer: ambiguous, for review
            return None, calls, f"{type(e).__name__}: {e}"

    def run(batches):
        for batch in batches:
            rows = []
            for key, prompt, operation in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                began = time.perf_counter()
                reply, calls, error = ask(prompt, operation)
                rows.append((key, reply, int(1000 * (time.perf_counter() - began)), calls, error))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in MEMO.split(", ")])

    return prompts.select("prompt_id", "prompt", "operation").mapInArrow(run, MEMO)


def prompt_id(config: EngineConfig, key: str) -> Column:
    """What a prompt's reply is kept by: the prompt, the model and the settings a reply hangs on; without a memo also the place that asks."""
    settings = json.dumps([config.model, config.endpoint, config.temperature, config.max_input_tokens, config.max_new_tokens, config.quantize, config.compute_dtype])
    own = [] if config.memo else [F.col(key).cast("string"), F.col("pos").cast("string")]
    return F.sha2(F.to_json(F.array(F.lit(settings), F.col("operation"), *own, F.col("prompt"))), 256)


def read_memo(spark: SparkSession, path: str) -> DataFrame:
    """The lasting memo at ``path``, MEMO; none if it is not there yet."""
    none = spark.createDataFrame([], MEMO)
    if not path:
        return none
    try:
        return spark.read.schema(none.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return none
        raise


@dataclass
class Adjudication:
    """``decisions``: key and FIELDS; ``failures``: key, operation, pos, error; ``calls``: counts over all rounds; ``resolved``: documents resolved by each round."""

    decisions: DataFrame
    failures: DataFrame
    calls: dict[str, int]
    resolved: list[int]


def adjudicate(sheets: DataFrame, questions: list[Question], config: EngineConfig, adjudicator: Adjudicator, key: str = "sheet_id", text: str = "raw_text") -> Adjudication:
    """The validated decisions that structuring ``sheets`` asks for.

    ``key`` tells rows apart. Documents without an open question leave: a round after the first one
    resolves just those that asked in the round before. New replies without an error are appended to
    the lasting memo (``config.memo_path``), so a later batch asks only what no batch has asked.
    """
    spark, ids, scratch = sheets.sparkSession, ordered_ids(questions), Scratch(sheets.sparkSession)
    active = scratch.table(detect(sheets.select(key, text), text).drop(text), "active")
    of = f"{key} {active.schema[key].dataType.simpleString()}"
    known = spark.createDataFrame([], f"{of}, {FIELDS}")  # decisions of active documents
    lasting = scratch.table(read_memo(spark, config.memo_path if config.memo else ""), "lasting")
    memo, done, rounds = spark.createDataFrame([], MEMO), [], []
    calls = dict.fromkeys(("asked", "memo_answered", "called", "retried", "failed"), 0)
    while True:
        rounds.append(active.count())
        now = resolve(active, questions, config, known, key).withColumn("_b", F.slice("boundary_open", 1, 1))
        now = now.withColumn("_m", F.when(F.size("_b") == 0, F.slice("mapping_open", 1, 1)).otherwise(F.array().cast("array<int>")))
        boundary = boundary_contexts(now.filter(F.size("_b") > 0), config, key, at=F.col("_b"))
        mapping = mapping_contexts(now.filter(F.size("_m") > 0), questions, key, at=F.col("_m"))
        asked = [(boundary, "boundary", boundary_prompt(questions, config)), (mapping, "mapping", mapping_prompt(questions, config))]
        asks = [rows.select(key, F.lit(op).alias("operation"), "pos", prompt.alias("prompt")) for rows, op, prompt in asked]
        ask = scratch.table(asks[0].unionByName(asks[1]).withColumn("prompt_id", prompt_id(config, key)), "ask")
        n = ask.count()
        if not n:
            break
        new = ask.dropDuplicates(["prompt_id"]).join(memo, "prompt_id", "left_anti").join(lasting, "prompt_id", "left_anti")
        seen = Observation()
        fresh = replies(new, adjudicator, config).observe(seen, F.count("*").alias("called"), F.count_if(F.col("calls") > 1).alias("retried"), F.count_if(F.col("error").isNotNull()).alias("failed"))
        fresh = scratch.table(fresh, f"replies{len(rounds)}")
        for name in ("called", "retried", "failed"):
            calls[name] += seen.get[name]
        calls["asked"], calls["memo_answered"] = calls["asked"] + n, calls["memo_answered"] + n - seen.get["called"]
        if config.memo and config.memo_path:
            fresh.filter("error is null").write.mode("append").parquet(config.memo_path)
        memo = memo.unionByName(fresh)
        found = parse_replies(ask.join(memo.unionByName(lasting).dropDuplicates(["prompt_id"]), "prompt_id").withColumn("reply", F.coalesce("reply", F.lit(""))))
        parts = [validate(found.filter(F.col("operation") == op), ids, op).select(*known.columns) for op in ("boundary", "mapping")]
        done.append(scratch.table(parts[0].unionByName(parts[1]), f"decisions{len(rounds)}"))
        still = ask.select(key)
        known = scratch.table(known.unionByName(done[-1]).join(still, key, "left_semi"), "known")
        active = scratch.table(active.join(still, key, "left_semi"), "active")
    every = known.limit(0)
    for part in done:
        every = every.unionByName(part)
    every = scratch.table(every, "decisions")
    scratch.keep("decisions")
    return Adjudication(every, every.filter("error is not null").select(key, "operation", "pos", "error"), calls, rounds)


def structure_with(sheets: DataFrame, questions: list[Question], config: EngineConfig, adjudicator: Adjudicator, key: str = "sheet_id", text: str = "raw_text") -> DataFrame:
    """``structure_sheets`` with the decisions of an adjudicator; the audit's duration is that of a document's replies."""
    if not config.adjudicate or not questions:
        return structure_sheets(sheets, questions, config, None, key, text)
    return structure_decided(sheets, questions, config, adjudicate(sheets, questions, config, adjudicator, key, text).decisions, key, text)


def structure_decided(sheets: DataFrame, questions: list[Question], config: EngineConfig, decisions: DataFrame, key: str, text: str) -> DataFrame:
    took = decisions.groupBy(key).agg(F.sum("duration_ms").alias("duration_ms"))
    return structure_sheets(sheets.join(took, key, "left").fillna(0, ["duration_ms"]), questions, config, decisions, key, text).drop("duration_ms")
