"""Mapping blocks to canonical questions, adjudication contexts and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.functions.folds import let, pieces, span
from markscribe.functions.text import once
from markscribe.operators.classify import DECISION, REVIEW


def ordered_ids(questions: list[Question]) -> list[str]:
    return [q.question_id for q in questions]


def decision_map(decisions: Column, operation: str) -> Column:
    """map<int, DECISION> by position of one operation's decisions in an array; of repeated decisions on one position the first in order of its fields stays."""
    value = lambda d: F.struct(d["decision"], d["question_id"], d["confidence"].cast("double"), d["requires_human_review"], d["subject_match"]).cast(DECISION)
    own = F.filter(decisions, lambda d: (d["operation"] == operation) & d["pos"].isNotNull())
    entries = F.array_sort(F.transform(own, lambda d: F.struct(d["pos"].cast("int").alias("key"), value(d).alias("value"))))
    return let(entries, lambda e: F.map_from_entries(F.filter(e, lambda x, i: (i == 0) | (x["key"] != F.get(e, i - 1)["key"]))))


def decision_maps(decisions: DataFrame, key: str = "sheet_id") -> DataFrame:
    """One row per document: boundary_decisions and mapping_decisions, as ``decision_map`` has them."""
    fields = ("operation", "pos", "decision", "question_id", "confidence", "requires_human_review", "subject_match")
    own = decisions.groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("_d"))
    return own.select(key, *(decision_map(F.col("_d"), o).alias(f"{o}_decisions") for o in ("boundary", "mapping")))


def is_prefix_block(b: Column, blocks: Column, ids: list[str], least: int) -> Column:
    """An unmarked first block of some length before others belongs to Q1."""
    return F.lit("Q1" in ids) & b["detected_marker"].isNull() & (b["source_order"] == 1) & (b["source_start"] == 0) & (F.size(blocks) > 1) & (F.length(b["text"]) >= least)


def map_blocks(df: DataFrame, questions: list[Question], config: EngineConfig, decisions: str | None = None) -> DataFrame:
    """Resolve ``blocks``; add ``mapping_review``, ``mapping_calls`` and ``mapping_open`` (blocks asked about that have no decision).

    Nothing is resolved unless adjudication is on.
    """
    ids = ordered_ids(questions)
    known = F.array(*(F.lit(i) for i in ids)).cast("array<string>")
    review = lambda bs: F.transform(bs, lambda b: F.struct(b["text"].alias("text"), known.alias("possible_questions")))
    if not config.adjudicate or not questions:
        off = review(F.col("blocks")) if not config.adjudicate else F.array().cast(f"array<{REVIEW}>")
        return df.withColumn("mapping_review", off).withColumn("mapping_calls", F.lit(0)).withColumn("mapping_open", F.array().cast("array<int>"))
    none = F.lit(None).cast(DECISION)

    def resolve(b: Column) -> Column:
        calls = F.col("boundary_calls") + F.when(F.col("structureless"), 0).otherwise(b["source_order"] - 1)
        # a map is searched from its beginning: no more is looked up than the budget has
        reply = F.when(calls < config.max_calls, F.col(decisions)[b["source_order"]]) if decisions else none

        def case(d: Column) -> Column:
            ok = (d["decision"] == "mapped") & d["question_id"].isNotNull() & d["subject_match"] & (d["confidence"] >= config.confidence_threshold) & ~d["requires_human_review"]
            prefix = is_prefix_block(b, F.col("blocks"), ids, config.prefix_chars)
            kind = F.when(calls >= config.max_calls, "over").when(F.col("structureless"), "none").when(prefix, "prefix").when(F.coalesce(ok, F.lit(False)), "mapped").otherwise("none")
            return let(kind, lambda k: placed(d, k))

        def placed(d: Column, k: Column) -> Column:
            sure = F.when(k == "prefix", F.when(d["question_id"] == "Q1", d["confidence"]).otherwise(0.6)).when(k == "mapped", d["confidence"]).otherwise(b["confidence"])
            status = F.when(k == "over", b["status"]).when(k == "none", "unmapped").otherwise("confirmed")
            resolved = F.when(k == "prefix", "Q1").when(k == "mapped", d["question_id"])
            return b.withField("resolved_question_id", resolved).withField("confidence", sure).withField("status", status)

        return let(reply, case)

    df = df.withColumn("blocks", once(F.transform("blocks", resolve)))
    left = F.filter("blocks", lambda b: b["status"] != "confirmed")
    used = F.when(F.col("structureless"), 0).otherwise(F.least(F.size("blocks"), F.greatest(F.lit(0), config.max_calls - F.col("boundary_calls"))))
    asked = F.transform(F.slice("blocks", F.lit(1), used), lambda b: b["source_order"])
    unanswered = F.filter(asked, lambda p: F.col(decisions)[p].isNull()) if decisions else asked
    return df.withColumn("mapping_review", review(left)).withColumn("mapping_calls", used).withColumn("mapping_open", unanswered)


def boundary_contexts(df: DataFrame, config: EngineConfig, key: str = "sheet_id", text: str = "normalized", at: Column | None = None) -> DataFrame:
    """One row per candidate, or per candidate at a position of ``at``, with what an adjudicator is shown.

    Contexts are cut in the document's row, so that no row of a candidate carries the whole text.
    """
    half = config.context_chars // 2
    df = df.withColumn("_cut", once(pieces(F.col(text)))).withColumn("_n", F.length(text)).withColumn("_c", F.col("candidates"))

    def shown(x: Column) -> Column:
        after, before = F.get("_c", x["pos"]), F.get("_c", x["pos"] - 2)
        end = F.coalesce(after["start"], F.least(F.col("_n"), x["end"] + half))
        start = F.greatest(F.lit(0), x["start"] - half)
        return F.struct(
            x["pos"].alias("pos"), x["line_text"].alias("candidate"), x["marker"].alias("candidate_marker"), F.size("_c").alias("candidate_count"),
            span(F.col("_cut"), start, x["start"] - start).alias("preceding"), span(F.col("_cut"), x["end"], end - x["end"]).alias("following"),
            before["marker"].alias("previous_marker"), before["line_text"].alias("previous_line"),
        )

    chosen = F.col("_c") if at is None else F.filter(F.transform(at, lambda p: F.get("_c", p - 1)), lambda c: c.isNotNull())
    df = df.withColumn("_shown", once(F.transform(chosen, shown))).withColumn("all_markers", once(F.array_join(F.transform("_c", lambda c: c["marker"]), "|")))
    return df.select(key, "all_markers", F.explode("_shown").alias("x")).select(
        key, "x.pos", "x.candidate", "x.candidate_marker", "x.candidate_count", "all_markers", "x.preceding", "x.following", "x.previous_marker", "x.previous_line"
    )


def canonical_text(questions: list[Question], config: EngineConfig = EngineConfig()) -> str:
    """The canonical questions as prompts show them: text and the beginning of the model answer."""
    lines = []
    for q in questions:
        lines.append(f"- {q.question_id}: {q.question_text}".strip())
        if excerpt := (q.model_answer or "")[: config.excerpt_chars]:
            lines.append(f"  model answer begins: {excerpt}")
    return "\n".join(lines) or "none given"


#: Our own wording of a boundary question, and the context that follows it.
BOUNDARY_TASK = (
    "Does this marker begin the answer to one of the questions, or is it a point inside an answer? Numbered points are mostly inside.",
    'Reply with one JSON object: decision ("question_boundary" or "continuation"), question_id (one of the ids, null for a continuation), confidence (0 to 1), reason, requires_human_review.',
)
BOUNDARY_PARTS = (
    ("Marker", "candidate_marker"), ("Line", "candidate"), ("Number", "pos"), ("Of", "candidate_count"), ("All markers", "all_markers"),
    ("Previous", "previous_marker"), ("Previous line", "previous_line"), ("Before", "preceding"), ("After", "following"),
)


def boundary_prompt(questions: list[Question] = (), config: EngineConfig = EngineConfig()) -> Column:
    """A boundary question, from ``boundary_contexts`` columns."""
    parts = [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for label, c in BOUNDARY_PARTS]
    return F.concat_ws("\n", *map(F.lit, BOUNDARY_TASK), *parts, F.lit("Questions:\n" + canonical_text(list(questions), config)))


def mapping_contexts(df: DataFrame, questions: list[Question], key: str = "sheet_id", at: Column | None = None) -> DataFrame:
    """One row per block, or per block at a position of ``at``, with what an adjudicator is shown: the block, the ids mapped before it, and those not mapped yet."""
    ids = F.array(*(F.lit(i) for i in ordered_ids(questions))).cast("array<string>")

    def shown(x: Column) -> Column:
        earlier = F.filter(F.transform(F.slice("_b", F.lit(1), x["source_order"] - 1), lambda b: b["resolved_question_id"]), lambda q: q.isNotNull())
        return F.struct(x["source_order"].alias("pos"), x["text"].alias("block"), x["detected_marker"].alias("marker"), earlier.alias("mapped"))

    df = df.withColumn("_b", F.col("blocks"))
    chosen = F.col("_b") if at is None else F.filter(F.transform(at, lambda p: F.get("_b", p - 1)), lambda b: b.isNotNull())
    each = df.withColumn("_shown", once(F.transform(chosen, shown))).select(key, F.explode("_shown").alias("x"))
    return each.select(key, "x.pos", "x.block", "x.marker", "x.mapped", F.array_except(ids, F.col("x.mapped")).alias("open_ids"))


def mapping_prompt(questions: list[Question], config: EngineConfig = EngineConfig()) -> Column:
    """Our own wording of a mapping question, from ``mapping_contexts`` columns."""
    listed = lambda c: F.when(F.size(c) == 0, "none").otherwise(F.array_join(c, ", "))
    return F.concat_ws(
        "\n",
        F.lit("Which of the questions does this part of an answer sheet answer, if any?"),
        F.lit('Reply with one JSON object: decision ("mapped", "unmapped" or "ambiguous"), question_id (one of the ids, else null), confidence (0 to 1), reason, requires_human_review, subject_match (false if it is about another subject).'),
        F.concat(F.lit("Part:\n"), F.col("block")), F.concat(F.lit("Marker: "), F.coalesce("marker", F.lit("-"))),
        F.concat(F.lit("Mapped before: "), listed("mapped")), F.concat(F.lit("Not mapped yet: "), listed("open_ids")),
        F.lit("Questions:\n" + canonical_text(questions, config)),
    )


def distinct_prompts(prompts: DataFrame) -> DataFrame:
    """prompt_id (SHA-256), prompt, uses: each prompt is put to an adjudicator once and joined back by id."""
    return prompts.withColumn("prompt_id", F.sha2("prompt", 256)).groupBy("prompt_id").agg(F.first("prompt").alias("prompt"), F.count("*").alias("uses"))
