"""Boundary classification: an ordered, stateful fold over each document's candidates.

Everything that does not depend on the fold's state (suppression, numbered runs, preambles,
ordinals) is computed beforehand; the fold itself is one ``aggregate`` in the document's row. With a
decision table the replies arrive as a map from candidate position to decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.functions.folds import let, scan
from markscribe.functions.text import integer_in, once
from markscribe.operators.markers import CANDIDATE, preamble_bounds, preamble_is_meaningful

DECISION = "struct<decision:string,question_id:string,confidence:double,requires_human_review:boolean,subject_match:boolean>"
REVIEW = "struct<text:string,possible_questions:array<string>>"


def canonical_numbers(questions: list[Question]) -> list[int]:
    """Numbers in ordinal order."""
    return sorted({q.number for q in questions})


def ordinals(questions: DataFrame, key: str = "path") -> DataFrame:
    """key, number, ordinal: the canonical order of each question set's distinct numbers."""
    return questions.select(key, "number").distinct().withColumn("ordinal", F.row_number().over(Window.partitionBy(key).orderBy("number")) - 1)


def _ordinal(number: Column, numbers: list[int]) -> Column:
    if not numbers:
        return F.lit(None).cast("int")
    at = F.array_position(F.array(*(F.lit(n).cast("bigint") for n in numbers)), number).cast("int")
    return F.when(at > 0, at - 1)


def repeated_later(candidates: Column) -> Column:
    """Candidate by candidate, whether a later one of any strength has its number; arrow markers are exempt."""
    by_number = F.array_sort(F.transform(candidates, lambda c: F.struct(c["number"].alias("number"), c["pos"].alias("pos"), F.contains(c["marker"], F.lit("→")).alias("arrow"))))
    again = lambda s, x, i: F.coalesce(~x["arrow"] & (F.get(s, i + 1)["number"] == x["number"]), F.lit(False))
    return F.transform(F.array_sort(let(by_number, lambda s: F.transform(s, lambda x, i: F.struct(x["pos"].alias("pos"), again(s, x, i).alias("again"))))), lambda x: x["again"])


def numbered_run(candidates: Column, c: Column) -> Column:
    """The next candidate is weak and one higher; arrow markers are exempt."""
    after = F.get(candidates, c["pos"])
    follows = (after["strength"] == "weak") & (after["number"] == c["number"] + 1)
    return F.coalesce(follows, F.lit(False)) & ~F.contains(c["marker"], F.lit("→"))


def enriched(df: DataFrame, numbers: list[int], text: str = "normalized", candidates: str = "candidates", out: str = "_each") -> DataFrame:
    """Add what the fold knows of every candidate beforehand; the text is read a fixed number of times."""
    df = df.withColumn("_bounds", once(preamble_bounds(F.col(text)))).withColumn("_again", once(repeated_later(F.col(candidates))))

    def each(c: Column) -> Column:
        return F.struct(
            c.alias("c"), _ordinal(c["number"], numbers).alias("ordinal"), F.get("_again", c["pos"] - 1).alias("suppressed"),
            numbered_run(F.col(candidates), c).alias("run"), preamble_is_meaningful(F.col(text), F.col("_bounds"), c["start"]).alias("meaningful"),
        )

    return df.withColumn(out, once(F.transform(candidates, each))).drop("_bounds", "_again")


def classify(x: Column, opened: Column, implicit: Column, n: int) -> Column:
    """boundary, continuation or ambiguous for a weak candidate under the fold's state."""
    effective = F.when(implicit, F.array_union(opened, F.array(F.lit(0)))).otherwise(opened)
    every = F.array(*(F.lit(i) for i in range(n)))

    def rule(e: Column, fill: Column) -> Column:
        return (
            F.when(x["ordinal"].isNull(), "continuation")
            .when((F.size(opened) == 0) & x["meaningful"], "continuation")
            .when(x["ordinal"] < fill, "continuation")
            .when((x["ordinal"] == fill) & (F.size(e) == fill), F.when(x["suppressed"], "continuation").otherwise("boundary"))
            .otherwise("ambiguous")
        )

    return let(effective, lambda e: let(F.coalesce(F.array_min(F.array_except(every, e)), F.lit(n)), lambda fill: rule(e, fill)))


def accept(df: DataFrame, questions: list[Question], config: EngineConfig, text: str = "normalized", candidates: str = "candidates", decisions: str | None = None) -> DataFrame:
    """Add ``accepted`` array<CANDIDATE>, ``boundary_review`` array<REVIEW>, ``boundary_calls`` and ``boundary_open`` (positions asked about that have no decision).

    ``decisions`` names a map<int, DECISION> of validated replies by position; without it every
    question put to the adjudicator comes back ambiguous and goes to review.
    """
    numbers = canonical_numbers(questions)
    if not numbers:
        strong = F.filter(candidates, lambda c: c["strength"] == "strong")
        return df.select("*", strong.alias("accepted"), F.array().cast(f"array<{REVIEW}>").alias("boundary_review"), F.lit(0).alias("boundary_calls"), F.array().cast("array<int>").alias("boundary_open"))
    df = enriched(df, numbers, text, candidates).withColumn("_implicit", once(F.coalesce(F.get("_each", F.lit(0))["meaningful"], F.lit(False))))
    ambiguous = F.struct(F.lit("ambiguous").alias("decision"), F.lit(None).cast("string").alias("question_id"), F.lit(0.0).alias("confidence"), F.lit(True).alias("requires_human_review"), F.lit(None).cast("boolean").alias("subject_match"))
    zero = F.struct(F.array().cast("array<int>").alias("opened"), F.lit(0).alias("calls"))
    budget = min(config.max_calls, config.max_boundary_calls)

    def ruling(acc: Column, x: Column) -> Column:
        first = F.when((x["c"]["strength"] == "strong") & x["ordinal"].isNotNull(), "boundary").when(
            x["c"]["strength"] == "weak", classify(x, acc["opened"], F.col("_implicit"), len(numbers))
        ).otherwise("ask")
        return let(first, lambda r: F.when(r != "ambiguous", r).when(x["run"], "continuation").otherwise("ask"))

    def outcome(asked: Column, x: Column, r: Column, reply: Column) -> Column:
        """mark (ordinal opened), taken, flagged, asked, possible ids and open (no decision) of one candidate."""
        ask = r == "ask"
        yes = (reply["decision"] == "question_boundary") & reply["question_id"].isNotNull() & (reply["confidence"] >= config.confidence_threshold) & ~reply["requires_human_review"]
        yes = asked & F.coalesce(yes, F.lit(False))
        mark = F.when(r == "boundary", x["ordinal"]).when(yes, _ordinal(integer_in(reply["question_id"]), numbers))
        flagged = (ask & ~asked) | (asked & ~yes & F.coalesce(reply["requires_human_review"], F.lit(False)))
        possible = F.when(asked & reply["question_id"].isNotNull(), F.array(reply["question_id"])).otherwise(F.array().cast("array<string>"))
        return F.struct(mark.alias("mark"), ((r == "boundary") | yes).alias("taken"), flagged.alias("flagged"), asked.alias("asked"), possible.alias("possible"))

    def advance(acc: Column, o: Column, unknown: Column) -> Column:
        opened = F.when(o["mark"].isNotNull(), F.array_union(acc["opened"], F.array(o["mark"]))).otherwise(acc["opened"])
        state = F.struct(opened.alias("opened"), (acc["calls"] + o["asked"].cast("int")).alias("calls"))
        return F.struct(state.alias("state"), F.struct(o["taken"].alias("taken"), o["flagged"].alias("flagged"), o["asked"].alias("asked"), (o["asked"] & unknown).alias("open"), o["possible"].alias("possible")).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        # a map is searched from its beginning: only what is asked, as often as the budget has it, is looked up
        asked = lambda r: (r == "ask") & (acc["calls"] < budget)
        known = lambda r: F.when(asked(r), F.col(decisions)[x["c"]["pos"]]) if decisions else F.lit(None).cast(DECISION)
        return let(ruling(acc, x), lambda r: let(known(r), lambda d: let(outcome(asked(r), x, r, F.coalesce(d, ambiguous)), lambda o: advance(acc, o, d.isNull()))))

    out = "struct<taken:boolean,flagged:boolean,asked:boolean,open:boolean,possible:array<string>>"
    df = df.withColumn("_fold", once(scan(F.col("_each"), zero, step, out)))
    df = df.withColumn("_fold", once(F.zip_with("_each", "_fold", lambda x, o: F.struct(x["c"].alias("c"), o.alias("o")))))
    kept = [x for x in df.columns if x not in ("_fold", "_each", "_implicit")]
    of = lambda flag: F.filter("_fold", lambda x: x["o"][flag])
    item = lambda x: F.struct(x["c"]["line_text"].alias("text"), x["o"]["possible"].alias("possible_questions"))
    return df.select(
        *kept, F.transform(of("taken"), lambda x: x["c"]).alias("accepted"), F.transform(of("flagged"), item).alias("boundary_review"),
        F.size(of("asked")).alias("boundary_calls"), F.transform(of("open"), lambda x: x["c"]["pos"]).alias("boundary_open"),
    )
