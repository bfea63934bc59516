"""Registered queries of the answer-sheet engine and their oracle SQL.

The driver's tables hold no answer sheets, so sheets are derived from ``conversations`` by a rule on
ids that both engines evaluate alike: each turn becomes a marked segment, with inner lists, noise and
references in prose; whole conversations become whole sheets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markscribe.config import EngineConfig, Question
from markscribe.functions.text import logical_lines, normalize_text, once, strip_tokens
from markscribe.operators import decisions as D
from markscribe.operators.assemble import debug_json, minimal_json, with_accessors
from markscribe.operators.blocks import with_blocks
from markscribe.operators.classify import accept, enriched, ordinals
from markscribe.operators.exploded import cut_rows, merge_rows, piece_rows
from markscribe.operators.legacy import extract_question, is_question_line, normalize_label, segment
from markscribe.operators.mapping import boundary_contexts, boundary_prompt, distinct_prompts, mapping_contexts
from markscribe.operators.markers import candidate_is_safe, is_page_line
from markscribe.plans import oracles
from markscribe.plans.pipeline import detect, resolve, structure_sheets
from markscribe.plans.scratch import Scratch
from markscribe.sources.canon import load_model_answers, parse_model_answers, parse_question_paper

NUMBERS = (1, 2, 3, 4, 5)
QUESTIONS = [Question(n, f"Question {n}") for n in NUMBERS]
IDS = [q.question_id for q in QUESTIONS]
OFF = EngineConfig(exam_id="exam")
ON = EngineConfig(exam_id="exam", adjudicate=True)

#: One SELECT for both engines: the segments of every sheet.
SEGMENTS = """
select conv_id as sheet_id, turn, concat(
  case when turn = 0 and conv_id % 4 = 1 then ''
       when turn % 6 = 0 then concat('Q', cast(turn + 1 as string), ' ')
       when turn % 6 = 1 then concat('Q.', cast(turn + 1 as string), ') ')
       when turn % 6 = 2 then concat('Question No. ', cast(turn + 1 as string), ' ')
       when turn % 6 = 3 then concat(cast(turn + 1 as string), '. ')
       when turn % 6 = 4 then concat(cast(turn + 1 as string), '→ ')
       else '' end,
  coalesce(text, ''),
  case when conv_id % 3 = 0 then concat(chr(10), '1. first point', chr(10), '2. second point') else '' end,
  case when conv_id % 5 = 0 then concat(chr(9), '<|im_end|>', '  ', chr(10), chr(10), chr(10)) else '' end,
  case when conv_id % 7 = 0 then concat(' see Q', cast(turn + 2 as string), ' again') else '' end) as seg
from conversations
"""
#: Rows of noise that the segments lack: no-break spaces, decomposed letters, other line ends, tokens.
NOISE = f"""
select -1 as sheet_id, concat('Q1', chr(160), chr(160), 'caf', 'e{chr(769)}', chr(13), chr(10), 'x', chr(13), 'y  z') as raw_text
union all select -2, concat('<s>a</s>', chr(10), chr(10), chr(10), chr(10), '<|assistant|>b <|im_ start c ', chr(9), chr(10), ' ')
union all select -3, concat(chr(160), ' ', chr(10))
"""
# The patterns of tokens and markers, as in the operators.
_SHEETS = f"sheets as (select sheet_id, string_agg(seg, chr(10) order by turn) as raw_text from ({SEGMENTS}) group by sheet_id)"
_TOKENS = r"regexp_replace(regexp_replace({0}, '<\|(?:im_[A-Za-z0-9_]*|assistant|user|endoftext)(?:\|>)?', '', 'g'), '</?s>', '', 'g')"
_STRIP = "trim({0}, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), chr(133), chr(160)))"
_FLAT = r"regexp_replace(replace(nfc_normalize(regexp_replace(raw_text, '\r\n?', chr(10), 'g')), chr(9), ' '), concat(chr(160), '+'), ' ', 'g')"
_NORMAL = _STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(" + _TOKENS.format(_FLAT) + r", ' {2,}', ' ', 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', concat(chr(10), chr(10)), 'g')")
_LINES = f"""{_SHEETS},
norm as (select sheet_id, {_NORMAL} as normalized from sheets),
lines as (select sheet_id, unnest(string_split(normalized, chr(10))) as line_text, generate_subscripts(string_split(normalized, chr(10)), 1) as line_no from norm)"""
_CANDIDATES = rf"""{_LINES},
found as (select *, regexp_extract_all(concat(' ', regexp_replace(line_text, '(\s)', '\1\1\1', 'g'), ' '), '(?i)[^A-Za-z0-9](Q\s*\.?\s*\d+|Question\s*(?:No\.?\s*)?\d+)\s*[.) :\-→]?\s', 1) as strong,
  regexp_extract(line_text, '^\s*(\d+\s*\.\)|\d+\s*[):\]]|\d+\s*\.|\(\s*\d+\s*\)|\d+\s*→|[①②③④⑤⑥⑦⑧⑨])\s*', 1) as weak from lines),
each as (
  select sheet_id, line_no, line_text, unnest(strong) as marker, generate_subscripts(strong, 1) as k, 'strong' as strength from found where len(strong) > 0
  union all select sheet_id, line_no, line_text, weak, 1, 'weak' from found where len(strong) = 0 and weak <> ''),
cand as (
  select sheet_id, cast(row_number() over (partition by sheet_id order by line_no, k) as int) as pos, regexp_replace(marker, '(\s)\s\s', '\1', 'g') as marker,
    try_cast(regexp_extract(marker, '\d+', 0) as bigint) as number, strength, line_text, line_no from each)"""


# --- inputs --------------------------------------------------------------------------------------


def marked_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sheet_id, raw_text of every conversation."""
    rows = spark.sql(SEGMENTS.replace("from conversations", "from {conversations}"), conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "seg"))), lambda x: x["seg"]), "\n")
    # a fixed number of partitions: adaptive execution would put small sheets, which cost much work each, into one task
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(parts, "sheet_id").groupBy("sheet_id").agg(joined.alias("raw_text"))


def _noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_sheets(spark, sf_dir).unionByName(spark.sql(NOISE))


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate."""
    return detect(marked_sheets(spark, sf_dir)).select("sheet_id", F.explode("candidates").alias("c")).select("sheet_id", "c.*")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate with what the fold knows of it beforehand."""
    df = enriched(detect(marked_sheets(spark, sf_dir)), list(NUMBERS), out="e")
    return df.select("sheet_id", F.explode("e").alias("e")).select("sheet_id", "e.c.*", "e.ordinal", "e.suppressed", "e.run", "e.meaningful")


#: Deterministic decisions, one SELECT for both engines; {cand} and {blocks} are (sheet_id, pos) lists.
BOUNDARY_REPLIES = """
select sheet_id, pos,
  case (sheet_id + pos) % 4 when 0 then 'question_boundary' when 1 then 'continuation' when 2 then 'question_boundary' else 'internal' end as decision,
  case (sheet_id + pos) % 5 when 0 then '9' when 1 then cast(pos % 5 + 1 as string) when 2 then concat('q', cast(pos % 5 + 1 as string), '.') when 3 then concat('Q ', cast(pos % 5 + 1 as string)) end as question_id,
  case (sheet_id + pos) % 6 when 0 then cast(0.95 as double) when 1 then cast(1.5 as double) when 2 then cast(0.6 as double) when 3 then cast(null as double) when 4 then cast(-2 as double) else cast(0.9 as double) end as confidence,
  case (sheet_id + pos) % 3 when 0 then false when 1 then cast(null as boolean) else (sheet_id + pos) % 9 = 8 end as requires_human_review,
  cast(null as boolean) as subject_match
from {0}
"""
MAPPING_REPLIES = """
select sheet_id, pos,
  case (sheet_id + pos) % 6 when 4 then 'unmapped' when 5 then 'mapped' else 'mapped' end as decision,
  concat('Q', cast((pos - 1) % 5 + 1 as string)) as question_id,
  case when (sheet_id + pos) % 6 = 5 then cast(null as double) else cast(0.9 as double) end as confidence,
  false as requires_human_review,
  (sheet_id + pos) % 6 <> 3 as subject_match
from {0}
"""


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of every sheet from 1 to one beyond its digits: every candidate has a digit, and blocks are one more at most."""
    digits = F.length("raw_text") - F.length(F.translate("raw_text", "0123456789①②③④⑤⑥⑦⑧⑨", ""))
    return marked_sheets(spark, sf_dir).select("sheet_id", F.explode(F.sequence(F.lit(1), digits + 1)).alias("pos"))


_POSITIONS = f"(with {_SHEETS} select sheet_id, unnest(range(1, length(raw_text) - length(translate(raw_text, '0123456789①②③④⑤⑥⑦⑧⑨', '')) + 2)) as pos from sheets)"


def _replies(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    name = f"markscribe_positions_{uuid.uuid4().hex}"
    _positions(spark, sf_dir).createOrReplaceTempView(name)
    try:
        return spark.sql(sql.format(name))
    finally:
        spark.catalog.dropTempView(name)


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validated decision table of both operations."""
    parts = [D.validate(_replies(spark, sf_dir, sql), IDS, op).withColumn("operation", F.lit(op)) for op, sql in (("boundary", BOUNDARY_REPLIES), ("mapping", MAPPING_REPLIES))]
    return parts[0].unionByName(parts[1])


def _structured(spark: SparkSession, sf_dir: str, on: bool = True) -> DataFrame:
    return structure_sheets(marked_sheets(spark, sf_dir), QUESTIONS, ON if on else OFF, _decisions(spark, sf_dir) if on else None)


#: Questions of one file.
_PER_FILE = 20


def _markdown(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """path, text: files of up to _PER_FILE questions each."""
    rows = spark.sql(f"select concat('paper', cast(item_id div {_PER_FILE} as string)) as path, item_id, {sql} as t from {{b}}", b=spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "t"))), lambda x: x["t"]), "\n").alias("text"))


_ONE_LINE = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
#: Every third answer has a form feed for a line end, every fourth marks in other digits.
_MARKS = "translate(cast(item_id % 9 + 1 as string), case when item_id % 4 = 1 then '0123456789' else '' end, case when item_id % 4 = 1 then '٠١٢٣٤٥٦٧٨٩' else '' end)"
_MODEL = f"concat('## Q', cast(item_id + 1 as string), '. ', trim(regexp_replace(text, '\\\\s+', ' ')), ' [', {_MARKS}, ' Marks]', chr(10), chr(10), 'Answer ', cast(item_id as string), '  ', case when item_id % 3 = 0 then chr(12) else chr(10) end, '### part', chr(10), '---', case when item_id % 3 = 1 then chr(12) else '' end)"
_HEADED = "concat('# Question No. ', cast(item_id + 1 as string), ':', case when item_id % 2 = 1 then chr(10) else ' ' end, trim(regexp_replace(text, '\\\\s+', ' ')), ' (', cast(item_id % 9 + 1 as string), ' marks)')"
_INLINED = "concat('Question ', cast(item_id + 1 as string), ') ', trim(regexp_replace(text, '\\\\s+', ' ')), chr(10), 'and more [', cast(item_id % 9 + 1 as string), ']')"
#: Lines and labels beside those of the sheets.
PAGE_LINES = "select -1 as sheet_id, x as line from (select explode(array('Page 12.', ' figure 3.2 :', 'TABLE 4', 'Chapter 7!', 'continued on next page', 'Continued', 'page twelve', 'page 3 of 9', 'Fig 1.2.3')) as x)"
LABELS = "select explode(array('I', 'l', 'QI', 'Ql', '7', ' q3. ', 'Q-4', '', 'x', '1.')) as label"


def _as_rows(df: DataFrame, items: str) -> tuple[DataFrame, DataFrame]:
    """The structs of ``items`` and the pieces of text, as rows.

    The cut and the merge read both several times: sheets are written once, or the whole engine would
    run anew for each reading.
    """
    scratch = Scratch(df.sparkSession)
    done = scratch.table(df.select("sheet_id", items, "normalized"), "sheets")
    scratch.keep("sheets")
    return done.select("sheet_id", F.explode(items).alias("x")).select("sheet_id", "x.*"), piece_rows(done)


def _resolved_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Blocks before they are merged, and pieces of text, as rows."""
    return _as_rows(resolve(detect(marked_sheets(spark, sf_dir)), QUESTIONS, ON, _decisions(spark, sf_dir)), "blocks")


def _cut_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_rows(*_as_rows(accept(detect(marked_sheets(spark, sf_dir)), QUESTIONS, OFF), "accepted"))


def _canonical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinals of each paper's questions, in the order of the file reversed."""
    return ordinals(parse_model_answers(_markdown(spark, sf_dir, _MODEL)).select("path", (F.lit(1000) - F.col("number")).alias("number")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_sheets(spark, sf_dir).select("sheet_id", F.explode(logical_lines(normalize_text(F.col("raw_text")))).alias("line"))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("sheet_id", "line", once(extract_question(F.col("line"))).alias("q"), is_question_line(F.col("line")).alias("is_question")).select("sheet_id", "line", "q.*", "is_question")


# --- queries -------------------------------------------------------------------------------------

QUERIES = {
    "marked_sheets": marked_sheets,
    "normalize_text": lambda s, d: _noisy(s, d).select("sheet_id", normalize_text(F.col("raw_text")).alias("normalized")),
    "scan_nonempty": lambda s, d: _noisy(s, d).select("sheet_id", normalize_text(F.col("raw_text")).alias("t")).filter("t <> ''").select("sheet_id", F.length("t").cast("long").alias("n_chars")),
    "strip_tokens": lambda s, d: _noisy(s, d).select("sheet_id", strip_tokens(F.col("raw_text")).alias("stripped")),
    "logical_lines": lambda s, d: marked_sheets(s, d).select("sheet_id", F.posexplode(logical_lines(normalize_text(F.col("raw_text")))).alias("line_no", "line")),
    "strong_markers": lambda s, d: _detected(s, d).filter("strength = 'strong'").select("sheet_id", "pos", "marker", "number", "line_text"),
    "weak_markers": lambda s, d: _detected(s, d).filter("strength = 'weak'").select("sheet_id", "pos", "marker", "number", "line_text"),
    "marker_offsets": lambda s, d: _detected(s, d).select("sheet_id", "pos", "start", "end", "marker"),
    "marker_lookup": lambda s, d: _candidates(s, d).select("sheet_id", "pos", F.when(F.col("ordinal").isNotNull(), F.concat(F.lit("Q"), "number")).alias("question_id")),
    "marker_safety": lambda s, d: _detected(s, d).select("sheet_id", "pos", candidate_is_safe(F.col("strength"), F.col("number"), IDS).alias("safe")),
    "unknown_strong": lambda s, d: _candidates(s, d).filter("strength = 'strong' and ordinal is null").select("sheet_id", "pos", "number"),
    "suppressed_markers": lambda s, d: _candidates(s, d).filter("suppressed").select("sheet_id", "pos", "marker"),
    "numbered_runs": lambda s, d: _candidates(s, d).filter("strength = 'weak' and run").select("sheet_id", "pos", "marker"),
    "header_preamble": lambda s, d: _candidates(s, d).filter("pos = 1").select("sheet_id", "meaningful"),
    "canonical_order": _canonical_order,
    "page_lines": lambda s, d: _lines(s, d).unionByName(s.sql(PAGE_LINES)).select("sheet_id", "line", is_page_line(F.col("line")).alias("is_page")),
    "label_normalizer": lambda s, d: _detected(s, d).select(F.col("marker").alias("label")).unionByName(s.sql(LABELS)).distinct().select("label", normalize_label(F.col("label")).alias("normalized")),
    "question_lines": _extracted,
    "boundary_fold": lambda s, d: accept(detect(marked_sheets(s, d)), QUESTIONS, OFF).select("sheet_id", F.explode("accepted").alias("a")).select("sheet_id", "a.pos", "a.marker"),
    "boundary_review": lambda s, d: accept(detect(marked_sheets(s, d)), QUESTIONS, OFF).select("sheet_id", "boundary_calls", F.size("boundary_review").alias("n_review")),
    "budget_overflow": lambda s, d: accept(detect(marked_sheets(s, d)), QUESTIONS, EngineConfig(max_boundary_calls=1)).select("sheet_id", "boundary_calls", F.size("boundary_review").alias("n_review")),
    "boundary_context": lambda s, d: boundary_contexts(detect(marked_sheets(s, d)), OFF),
    "cut_blocks": lambda s, d: with_blocks(accept(detect(marked_sheets(s, d)), QUESTIONS, OFF), True).select("sheet_id", F.explode("blocks").alias("b")).select("sheet_id", "b.source_order", "b.detected_marker", "b.source_start", "b.source_end", "b.text"),
    "strong_only_blocks": lambda s, d: with_blocks(accept(detect(marked_sheets(s, d)), [], OFF), False).select("sheet_id", F.explode("blocks").alias("b")).select("sheet_id", "b.source_order", "b.detected_marker", "b.text"),
    "prefix_blocks": lambda s, d: with_blocks(accept(detect(marked_sheets(s, d)), QUESTIONS, OFF), True).select("sheet_id", F.get("blocks", F.lit(0)).alias("b")).filter("b.detected_marker is null").select("sheet_id", "b.text"),
    "structureless_docs": lambda s, d: with_blocks(accept(detect(marked_sheets(s, d)), QUESTIONS, OFF), True).select("sheet_id", "structureless"),
    "parse_decisions": lambda s, d: D.parse_replies(_raw_replies(s, d)).select("sheet_id", "pos", "parsed", "decision", "question_id", "confidence", "requires_human_review", "subject_match"),
    "validate_decisions": lambda s, d: D.validate(_replies(s, d, BOUNDARY_REPLIES), IDS, "boundary"),
    "mapping_gate": lambda s, d: D.validate(_replies(s, d, MAPPING_REPLIES), IDS, "mapping").select("sheet_id", "pos", "decision", D.gate(0.85).alias("accepted")),
    "prompt_dedup": lambda s, d: distinct_prompts(boundary_contexts(detect(marked_sheets(s, d)), OFF).select(boundary_prompt().alias("prompt"))),
    "cut_blocks_exploded": _cut_rows,
    "merge_adjacent_exploded": lambda s, d: merge_rows(*_resolved_blocks(s, d)).select("sheet_id", "source_order", "resolved_question_id", "source_start", "source_end", "confidence", "status", "text"),
    "merge_adjacent": lambda s, d: _structured(s, d).select("sheet_id", F.explode("blocks").alias("b")).select("sheet_id", "b.source_order", "b.resolved_question_id", "b.source_start", "b.source_end", "b.confidence", "b.status"),
    "answers_by_question": lambda s, d: _structured(s, d).select("sheet_id", F.explode("questions").alias("q")).select("sheet_id", "q.question_id", F.size("q.answers").alias("n_answers"), F.array_join("q.answers", "\n--\n").alias("answers")),
    "unmapped_distinct": lambda s, d: _structured(s, d).select("sheet_id", F.posexplode("unmapped").alias("at", "text")),
    "review_distinct": lambda s, d: _structured(s, d).select("sheet_id", F.posexplode("review").alias("at", "r")).select("sheet_id", "at", "r.text", F.array_join("r.possible_questions", ",").alias("possible")),
    "unadjudicated": lambda s, d: _structured(s, d, on=False).select("sheet_id", F.size("unmapped").alias("n_unmapped"), F.size("review").alias("n_review")),
    "audit_counts": lambda s, d: _structured(s, d).select("sheet_id", "audit.*"),
    "mapping_context": lambda s, d: mapping_contexts(resolve(detect(marked_sheets(s, d)), QUESTIONS, ON, _decisions(s, d)), QUESTIONS).select("sheet_id", "pos", "block", "marker", F.array_join("mapped", ",").alias("mapped"), F.array_join("open_ids", ",").alias("open_ids")),
    "accessors": lambda s, d: with_accessors(_structured(s, d)).select("student_id", F.size("review_items").alias("n_review"), F.size("unmapped_content").alias("n_unmapped"), "processing_status"),
    "minimal_json": lambda s, d: _structured(s, d).select("sheet_id", minimal_json(F.col("sheet_id")).alias("json")),
    "debug_json": lambda s, d: _structured(s, d).select("sheet_id", debug_json(F.col("sheet_id"), "raw_text").alias("json")),
    "model_answer_sections": lambda s, d: parse_model_answers(_markdown(s, d, _MODEL)),
    "model_answer_map": lambda s, d: load_model_answers(parse_model_answers(_markdown(s, d, _MODEL))).select("path", F.explode("answers").alias("question_id", "model_answer")),
    "paper_headings": lambda s, d: parse_question_paper(_markdown(s, d, _HEADED)).drop("model_answer"),
    "paper_inline": lambda s, d: parse_question_paper(_markdown(s, d, _INLINED)).drop("model_answer"),
    "legacy_segments": lambda s, d: marked_sheets(s, d).select("sheet_id", once(normalize_text(F.col("raw_text"))).alias("t")).select("sheet_id", once(segment(F.col("t"))).alias("s")).select("sheet_id", F.posexplode("s").alias("at", "x")).select("sheet_id", "at", "x.question", "x.answer"),
}

#: Raw replies as an adjudicator might send them: fields that hang on sheet and position, in varied JSON kinds, then wrapped, nested or broken.
RAW_REPLIES = """
select sheet_id, pos, case (sheet_id + 3 * pos) % 11
  when 0 then concat('```json', chr(10), body, chr(10), '```')
  when 1 then concat('``` ', body, '```')
  when 2 then concat('Sure, ', body, ' as asked, not {"decision": "unmapped"}')
  when 3 then concat('{"note": "first"} then ', body)
  when 4 then concat('no json at ', cast(pos as string))
  when 5 then concat('[', body, ']')
  when 6 then concat(substr(body, 1, length(body) - 1), ', "extra": {"decision": "mapped", "page": [', cast(pos as string), ', null]}}')
  when 7 then substr(body, 1, length(body) - 1)
  when 8 then concat(chr(10), '  ', body, chr(10))
  else body end as reply
from (select sheet_id, pos, concat('{',
    case (sheet_id + pos) % 6 when 0 then '' when 1 then '"decision": null, ' else concat('"decision": "', case (sheet_id + pos) % 4 when 0 then 'mapped' when 1 then 'unmapped' when 2 then 'ambiguous' else concat('kind ', cast(pos as string)) end, '", ') end,
    case (sheet_id + pos) % 5 when 0 then '' when 1 then '"question_id": null, ' when 2 then concat('"question_id": ', cast(pos as string), ', ') else concat('"question_id": "Q', cast(pos as string), '", ') end,
    case (2 * sheet_id + pos) % 7 when 0 then '"requires_human_review": true, ' when 1 then '"requires_human_review": "False", ' when 2 then '"needs_human_review": 1, ' when 3 then '"requires_human_review": "maybe", ' when 4 then '"requires_human_review": null, "needs_human_review": "true", ' when 5 then '"requires_human_review": 0, ' else '' end,
    case (sheet_id + 2 * pos) % 6 when 0 then '"subject_match": true, ' when 1 then '"subject_match": " 0 ", ' when 2 then '"subject_compat": "TRUE", ' when 3 then '"subject_match": [true], ' when 4 then '"subject_match": 2, ' else '' end,
    '"confidence": ', case (sheet_id + pos) % 8 when 0 then concat('0.', cast(pos as string)) when 1 then concat('"0.', cast(pos as string), '"') when 2 then 'true' when 3 then '"high"' when 4 then concat('" -', cast(pos as string), 'e-1 "') when 5 then 'null' when 6 then cast(pos as string) else '{"value": 1}' end,
    '}') as body from ROWS)
"""


def _raw_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir, RAW_REPLIES.replace("{", "{{").replace("}", "}}").replace("ROWS", "{0}"))


# --- oracles -------------------------------------------------------------------------------------

_NOISY = f"with {_SHEETS}, noisy as (select * from sheets union all {NOISE})"
_VALID = f"""with r as ({BOUNDARY_REPLIES.format(_POSITIONS)}),
v as (select *, decision in ('question_boundary', 'continuation') as known,
  case when regexp_full_match(upper(trim(question_id)), 'Q?\\s*\\d+\\.?') then concat('Q', regexp_extract(question_id, '\\d+', 0)) end as q0 from r),
w as (select *, case when q0 in ('Q1', 'Q2', 'Q3', 'Q4', 'Q5') then q0 end as q1 from v)
select sheet_id, pos, case when known then decision else 'ambiguous' end as decision, q1 as question_id, (case when confidence is null then 0 else greatest(0, least(1, confidence)) end)::double as confidence,
  confidence is null or not known or (question_id is not null and q1 is null) or coalesce(requires_human_review, false) or (decision = 'question_boundary' and q1 is null) as requires_human_review, subject_match from w"""
_C = f"with {_CANDIDATES} "
_KNOWN = "number between 1 and 5"
ORACLES = {
    "marked_sheets": f"with {_SHEETS} select * from sheets",
    "normalize_text": f"{_NOISY} select sheet_id, {_NORMAL} as normalized from noisy",
    "scan_nonempty": f"{_NOISY} select sheet_id, length({_NORMAL}) as n_chars from noisy where {_NORMAL} <> ''",
    "strip_tokens": f"{_NOISY} select sheet_id, {_TOKENS.format('raw_text')} as stripped from noisy",
    "logical_lines": f"with {_LINES}, kept as (select sheet_id, line_no, {_STRIP.format('line_text')} as line from lines) select sheet_id, cast(row_number() over (partition by sheet_id order by line_no) - 1 as int) as line_no, line from kept where line <> ''",
    "strong_markers": _C + "select sheet_id, pos, marker, number, line_text from cand where strength = 'strong'",
    "weak_markers": _C + "select sheet_id, pos, marker, number, line_text from cand where strength = 'weak'",
    "marker_lookup": _C + f"select sheet_id, pos, case when {_KNOWN} then concat('Q', cast(number as string)) end as question_id from cand",
    "marker_safety": _C + f"select sheet_id, pos, strength = 'strong' and coalesce({_KNOWN}, false) as safe from cand",
    "unknown_strong": _C + f"select sheet_id, pos, number from cand where strength = 'strong' and not coalesce({_KNOWN}, false)",
    "suppressed_markers": _C + "select sheet_id, pos, marker from (select *, max(pos) over (partition by sheet_id, number) as last from cand) where number is not null and last > pos and not contains(marker, '→')",
    "numbered_runs": _C + "select sheet_id, pos, marker from (select *, lead(strength) over w as s2, lead(number) over w as n2 from cand window w as (partition by sheet_id order by pos)) where strength = 'weak' and s2 = 'weak' and n2 = number + 1 and not contains(marker, '→')",
    "canonical_order": f"select concat('paper', cast(item_id // {_PER_FILE} as string)) as path, cast(1000 - (item_id + 1) as int) as number, cast(row_number() over (partition by item_id // {_PER_FILE} order by item_id desc) - 1 as int) as ordinal from benchmark",
    "validate_decisions": _VALID,
    "mapping_gate": f"with r as ({MAPPING_REPLIES.format(_POSITIONS)}) select sheet_id, pos, case when decision = 'mapped' and not subject_match then 'ambiguous' else decision end as decision, decision = 'mapped' and subject_match and coalesce(confidence, 0) >= 0.85 as accepted from r",
    "parse_decisions": oracles.parsed(RAW_REPLIES.replace("ROWS", _POSITIONS)),
    "model_answer_sections": f"select {oracles.PAPER.format(n=_PER_FILE)}, {_ONE_LINE} as question_text, cast(item_id % 9 + 1 as int) as max_marks, concat('Answer ', cast(item_id as string), chr(10), '### part', chr(10), '---') as model_answer from benchmark",
    "model_answer_map": f"select concat('paper', cast(item_id // {_PER_FILE} as string)) as path, concat('Q', cast(item_id + 1 as string)) as question_id, concat('Answer ', cast(item_id as string), chr(10), '### part', chr(10), '---') as model_answer from benchmark",
    "paper_headings": f"select {oracles.PAPER.format(n=_PER_FILE)}, {_ONE_LINE} as question_text, cast(item_id % 9 + 1 as int) as max_marks from benchmark",
    "paper_inline": f"select {oracles.PAPER.format(n=_PER_FILE)}, concat({_ONE_LINE}, ' and more') as question_text, cast(item_id % 9 + 1 as int) as max_marks from benchmark",
    "page_lines": f"with {_LINES}, all_lines as (select sheet_id, {_STRIP.format('line_text')} as line from lines union all {PAGE_LINES.replace('explode(array(', 'unnest([').replace('))', '])')}) select sheet_id, line, {oracles.PAGE.format('line')} as is_page from all_lines where line <> ''",
    "label_normalizer": f"with {_CANDIDATES}, labels as (select marker as label from cand union {LABELS.replace('explode(array(', 'unnest([').replace('))', '])')}), t as (select label, replace(replace(upper(trim(label)), '.', ''), '-', '') as x from labels) select label, case when x in ('I', 'L', 'QI', 'QL') then 'Q1' when regexp_full_match(x, '[0-9]+') then concat('Q', x) else x end as normalized from t",
}
#: Positions in the text, the fold as a recursion, blocks, mapping and what is made of them.
_REPLIES = {"boundary": f"select sheet_id, pos, decision, question_id, confidence, requires_human_review as review from ({_VALID})", "mapping": oracles.mapping_replies(MAPPING_REPLIES.format(_POSITIONS))}
ORACLES |= oracles.folded(_CANDIDATES, _REPLIES, IDS, ON)
ORACLES |= oracles.legacy(_LINES)
