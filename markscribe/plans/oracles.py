"""Oracle SQL of what depends on offsets and on the fold: a recursion over each sheet's candidates, then blocks, mapping and assembly.

``{candidates}`` are the common tables up to ``cand`` (sheet_id, pos, marker, number, strength,
line_no, line_text) with ``norm`` and ``lines``; the sheets' own lines end in \n only.
"""

from __future__ import annotations

from markscribe.operators.mapping import BOUNDARY_PARTS, BOUNDARY_TASK

# The page grammar, weak markers and what may follow a strong one, as in the operators.
PAPER = "concat('paper', cast(item_id // {n} as string)) as path, cast(row_number() over (partition by item_id // {n} order by item_id) as int) as ord, concat('Q', cast(item_id + 1 as string)) as question_id, cast(item_id + 1 as int) as number"
PAGE = r"regexp_matches({0}, '(?i)^\s*(?:page\s+\d+|fig(?:ure)?\s+\d+(?:\.\d+)?|table\s+\d+(?:\.\d+)?|chapter\s+\d+|continued(?:\s+on\s+next\s+page)?)\s*[.!:]?\s*$')"
_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_WEAK = r"^\s*(?:\d+\s*\.\)|\d+\s*[):\]]|\d+\s*\.|\(\s*\d+\s*\)|\d+\s*→|[①②③④⑤⑥⑦⑧⑨])\s*"
_TAIL = r"^(\s*[.) :\-→]?)(?:\s|$)"


AUDIT = ("calls", "boundary_calls", "mapping_calls", "model", "device", "dtype", "quantization", "duration_ms", "exam_id", "candidate_count", "accepted_count", "block_count", "review_count", "unmapped_count")


def _strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def mapping_replies(rows: str) -> str:
    """The validated decisions of the mapping replies, whose ids are all known."""
    return f"""select sheet_id, pos, case when decision = 'mapped' and not subject_match then 'ambiguous' else decision end as decision, question_id, coalesce(confidence, 0) as confidence,
  confidence is null or (decision = 'mapped' and not subject_match) as review, subject_match from ({rows})"""


def _info(candidates: str, n: int) -> str:
    """info: candidates with offsets and all that the fold knows beforehand."""
    return rf"""{candidates},
starts as (select sheet_id, line_no, coalesce(sum(length(line_text) + 1) over (partition by sheet_id order by line_no rows between unbounded preceding and 1 preceding), 0) as line_at from lines),
placed as (
  select c.*, s.line_at + case when strength = 'strong' then strpos(c.line_text, marker) - 1 else 0 end as start from cand c join starts s using (sheet_id, line_no)),
ended as (
  select p.*, n.normalized, start + case when strength = 'weak' then length(regexp_extract(line_text, '{_WEAK}')) else length(marker) + length(regexp_extract(substr(normalized, cast(start as bigint) + length(marker) + 1), '{_TAIL}', 1)) end as stop
  from placed p join norm n using (sheet_id)),
before as (select *, {_strip("substr(normalized, 1, cast(start as bigint))")} as preamble from ended),
info as (
  select sheet_id, pos, marker, number, strength, line_text, cast(start as int) as start, cast(stop as int) as stop, case when number between 1 and {n} then cast(number - 1 as int) end as ordinal,
    preamble <> '' and not {PAGE.format("preamble")} and not (len([x for x in string_split(preamble, chr(10)) if trim(x) <> '']) = 1 and length(preamble) <= 80) as meaningful,
    number is not null and not contains(marker, '→') and max(pos) over (partition by sheet_id, number) > pos as suppressed,
    coalesce(lead(strength) over w = 'weak' and lead(number) over w = number + 1, false) and not contains(marker, '→') as run
  from before window w as (partition by sheet_id order by pos))"""


def _fold(candidates: str, n: int, replies: str | None, budget: int, threshold: float) -> str:
    """info and fold (a row per candidate and one before them), with the running state."""
    known = replies or "select 0 as sheet_id, 0 as pos, 'ambiguous' as decision, cast(null as varchar) as question_id, 0.0 as confidence, true as review where false"
    fill = " ".join(f"when eff & {1 << i} = 0 then {i}" for i in range(n))
    return f"""with recursive {_info(candidates, n)},
boundary as ({known}),
asked as (
  select i.*, coalesce(d.decision, 'ambiguous') as decision, d.question_id, coalesce(d.confidence, 0) as confidence, coalesce(d.review, true) as review,
    case when first_value(i.meaningful) over (partition by i.sheet_id order by i.pos) then 1 else 0 end as implicit
  from info i left join boundary d on d.sheet_id = i.sheet_id and d.pos = i.pos),
fold as (
  select sheet_id, cast(0 as int) as pos, cast(0 as int) as opened, cast(0 as int) as calls, false as taken, false as flagged, cast(null as varchar) as possible from norm
  union all
  select sheet_id, pos, cast(case when ruling = 'boundary' then opened | (1 << ordinal) when yes then opened | (1 << (cast(substr(question_id, 2) as int) - 1)) else opened end as int),
    cast(calls + case when ask then 1 else 0 end as int), ruling = 'boundary' or yes, (ruling = 'ask' and not ask) or (ask and not yes and review), case when ask then question_id end
  from (
    select *, ask and decision = 'question_boundary' and question_id is not null and confidence >= {threshold} and not review as yes from (
      select *, ruling = 'ask' and calls < {budget} as ask from (
        select *, case when strength = 'strong' and ordinal is not null then 'boundary' when strength = 'strong' then 'ask' when ordinal is null then 'continuation'
            when opened = 0 and meaningful then 'continuation' when ordinal < fill then 'continuation'
            when ordinal = fill and eff = (1 << fill) - 1 then case when suppressed then 'continuation' else 'boundary' end
            when run then 'continuation' else 'ask' end as ruling from (
          select *, case {fill} else {n} end as fill from (
            select a.*, f.opened, f.calls, f.opened | a.implicit as eff from fold f join asked a on a.sheet_id = f.sheet_id and a.pos = f.pos + 1)))))),
accepted as (select i.* from info i join fold f using (sheet_id, pos) where f.taken),
totals as (select sheet_id, max(calls) as calls from fold group by sheet_id),
noted as (select f.sheet_id, f.pos, i.line_text as text, coalesce(f.possible, '') as possible from fold f join info i using (sheet_id, pos) where f.flagged)"""


_BLOCKS = f""",
cuts as (select *, lead(start) over (partition by sheet_id order by pos) as next, row_number() over (partition by sheet_id order by pos) as k from accepted),
pieces as (
  select n.sheet_id, 0 as k, normalized as text, 0 as source_start, length(normalized) as source_end, cast(null as varchar) as detected_marker from norm n where normalized <> '' and not exists (select 1 from accepted a where a.sheet_id = n.sheet_id)
  union all select sheet_id, 0, {_strip("substr(normalized, 1, start)")}, 0, start, null from cuts join norm using (sheet_id) where k = 1 and start > 0 and {_strip("substr(normalized, 1, start)")} <> '' and not {PAGE.format(_strip("substr(normalized, 1, start)"))}
  union all select sheet_id, k, {_strip("substr(normalized, stop + 1, coalesce(next, length(normalized)) - stop)")}, stop, coalesce(next, length(normalized)), marker from cuts join norm using (sheet_id)),
blocks as (
  select *, cast(row_number() over (partition by sheet_id order by k) as int) as source_order, count(*) over (partition by sheet_id) as n_blocks, first_value(detected_marker) over (partition by sheet_id order by k) as first_marker
  from pieces where text <> ''),
sizes as (select n.sheet_id, (select count(*) from info i where i.sheet_id = n.sheet_id) as n_candidates, (select count(*) from accepted a where a.sheet_id = n.sheet_id) as n_accepted from norm n),
shape as (select s.*, coalesce(b.n_blocks, 0) as n_blocks, s.n_candidates > 1 and coalesce(b.n_blocks, 0) = 1 and b.first_marker is null as structureless from sizes s left join (select distinct sheet_id, n_blocks, first_marker from blocks) b using (sheet_id))"""


def _mapped(replies: str | None, ids: list[str], config) -> str:
    """resolved (blocks after mapping), merged (after merging), ended_blocks (after the last rule), unmapped and reviewed."""
    known = ",".join(sorted(ids))
    on = replies is not None
    if on:
        resolved = f"""
mapping as ({replies}),
kinds as (
  select b.*, m.decision, m.question_id, m.confidence as sure, m.review, m.subject_match, case when t.calls + case when s.structureless then 0 else source_order - 1 end >= {config.max_calls} then 'over'
    when s.structureless then 'none'
    when {str("Q1" in ids).lower()} and detected_marker is null and source_order = 1 and source_start = 0 and b.n_blocks > 1 and length(text) >= {config.prefix_chars} then 'prefix'
    when coalesce(m.decision = 'mapped' and m.question_id is not null and m.subject_match and m.confidence >= {config.confidence_threshold} and not m.review, false) then 'mapped' else 'none' end as kind
  from blocks b join totals t using (sheet_id) join shape s using (sheet_id) left join mapping m on m.sheet_id = b.sheet_id and m.pos = b.source_order),
resolved as (
  select sheet_id, source_order, text, source_start, source_end, detected_marker, case kind when 'prefix' then 'Q1' when 'mapped' then question_id end as resolved_question_id,
    cast(case kind when 'prefix' then case when question_id = 'Q1' then sure else 0.6 end when 'mapped' then sure else 0 end as double) as confidence,
    case kind when 'over' then 'needs_mapping' when 'none' then 'unmapped' else 'confirmed' end as status from kinds)"""
    else:
        resolved = """
resolved as (select sheet_id, source_order, text, source_start, source_end, detected_marker, cast(null as varchar) as resolved_question_id, cast(0 as double) as confidence, 'needs_mapping' as status from blocks)"""
    strong = r"regexp_matches(detected_marker, '(?i)^(?:Q\s*\.?\s*\d+|Question\s*(?:No\.?\s*)?\d+)')"
    return f""",{resolved},
joins as (
  select r.*, coalesce(lag(resolved_question_id) over w = resolved_question_id and {_strip("substr(normalized, lag(source_end) over w + 1, source_start - lag(source_end) over w)")} = {_strip("detected_marker")}
    and {_strip("detected_marker")} <> '' and not {strong}, false) as joined from resolved r join norm using (sheet_id) window w as (partition by sheet_id order by source_order)),
runs as (select *, sum(case when joined then 0 else 1 end) over (partition by sheet_id order by source_order) as run from joins),
merged as (
  select r.sheet_id, cast(min(source_order) as int) as source_order, case when count(*) = 1 then any_value(text) else any_value(substr(normalized, r0 + 1, r1 - r0)) end as text, cast(min(source_start) as int) as source_start, cast(max(source_end) as int) as source_end,
    arg_min(resolved_question_id, source_order) as resolved_question_id, max(confidence) as confidence, arg_min(status, source_order) as status
  from (select *, min(source_start) over (partition by sheet_id, run) as r0, max(source_end) over (partition by sheet_id, run) as r1 from runs) r join norm using (sheet_id) group by r.sheet_id, run),
lonely as (
  select sheet_id from shape where n_candidates > 1 and (select count(*) from merged m where m.sheet_id = shape.sheet_id) = 1
    and exists (select 1 from merged m where m.sheet_id = shape.sheet_id and (m.status = 'unmapped' or m.resolved_question_id is null))),
ended_blocks as (select m.* exclude (status, resolved_question_id), case when l.sheet_id is null then status else 'unmapped' end as status, case when l.sheet_id is null then resolved_question_id end as resolved_question_id from merged m left join lonely l using (sheet_id)),
bare as (select n.sheet_id, n.normalized as text from norm n where {_strip("normalized")} <> '' and not exists (select 1 from merged m where m.sheet_id = n.sheet_id)),
unmapped_all as (select sheet_id, 0 as k, text from bare union all select sheet_id, source_order, text from ended_blocks where status = 'unmapped'),
unmapped as (select sheet_id, text, row_number() over (partition by sheet_id order by min(k)) - 1 as "at" from unmapped_all group by sheet_id, text),
review_all as (
  select sheet_id, 0 as part, pos as k, text, possible from noted
  union all select sheet_id, 1, source_order, text, '{known}' from resolved where {"status <> 'confirmed'" if on else "true"}
  union all select e.sheet_id, 2, 0, e.text, '{known}' from ended_blocks e join lonely using (sheet_id)
  {"" if on else f"union all select sheet_id, 3, 0, text, '{known}' from bare"}),
reviewed as (
  select sheet_id, text, possible, row_number() over (partition by sheet_id order by min(part * 1000000 + k)) - 1 as "at"
  from (select sheet_id, part, k, {_strip("text")} as text, possible from review_all) where text <> '' group by sheet_id, text, possible)"""


def folded(candidates: str, replies: dict[str, str], ids: list[str], config) -> dict[str, str]:
    """The oracles, by query."""
    n, budget, threshold = len(ids), min(config.max_calls, config.max_boundary_calls), config.confidence_threshold
    info = f"with {_info(candidates, n)} "
    off = _fold(candidates, n, None, budget, threshold)
    on = _fold(candidates, n, replies["boundary"], budget, threshold) + _BLOCKS + _mapped(replies["mapping"], ids, config)
    half = config.context_chars // 2
    listed = "(values " + ", ".join(f"('{i}', {k})" for k, i in enumerate(ids)) + ") q(question_id, ord)"
    count = lambda table: f"(select count(*) from {table} x where x.sheet_id = s.sheet_id)"
    review = "select sheet_id, calls as boundary_calls, cast((select count(*) from noted x where x.sheet_id = t.sheet_id) as int) as n_review from totals t"
    strong_only = f"with {_info(candidates, n)}, accepted as (select * from info where strength = 'strong')"
    context = f"""select sheet_id, pos, line_text as candidate, marker as candidate_marker, cast(count(*) over s as int) as candidate_count, string_agg(marker, '|') over (partition by sheet_id order by pos rows between unbounded preceding and unbounded following) as all_markers,
  substr(normalized, greatest(0, start - {half}) + 1, start - greatest(0, start - {half})) as preceding,
  substr(normalized, stop + 1, coalesce(lead(start) over w, least(length(normalized), stop + {half})) - stop) as following,
  lag(marker) over w as previous_marker, lag(line_text) over w as previous_line from info join norm using (sheet_id) window w as (partition by sheet_id order by pos), s as (partition by sheet_id)"""
    mapped_before = "string_agg(resolved_question_id, ',') over (partition by sheet_id order by source_order rows between unbounded preceding and 1 preceding)"
    audit = f"""select sheet_id, cast(t.calls + m as int) as calls, t.calls as boundary_calls, cast(m as int) as mapping_calls, '{config.model}' as model, '{config.device}' as device, '{config.compute_dtype}' as dtype, '{config.quantization}' as quantization,
  cast(0 as bigint) as duration_ms, '{config.exam_id}' as exam_id, cast(s.n_candidates as int) as candidate_count, cast(s.n_accepted as int) as accepted_count,
  cast({count('ended_blocks')} as int) as block_count, cast({count('reviewed')} as int) as review_count, cast({count('unmapped')} as int) as unmapped_count
  from (select s.*, case when structureless then 0 else least(n_blocks, greatest(0, {config.max_calls} - (select calls from totals x where x.sheet_id = s.sheet_id))) end as m from shape s) s join totals t using (sheet_id)"""
    answers = lambda i: f"(select case count(*) when 0 then 'null'::json when 1 then to_json(any_value(e.text)) else to_json(list(e.text order by e.source_order)) end from ended_blocks e where e.sheet_id = s.sheet_id and e.resolved_question_id = '{i}')"
    return {
        "marker_offsets": info + 'select sheet_id, pos, start, stop as "end", marker from info',
        "header_preamble": info + "select sheet_id, meaningful from info where pos = 1",
        "boundary_fold": off + " select sheet_id, pos, marker from accepted",
        "boundary_review": off + " " + review,
        "budget_overflow": _fold(candidates, n, None, 1, threshold) + " " + review,
        "boundary_context": info + context,
        "prompt_dedup": info + f"""select sha256(prompt) as prompt_id, prompt, count(*) as uses from (
  select concat_ws(chr(10), {", ".join(f"'{x}'" for x in BOUNDARY_TASK)}, {", ".join(f"concat('{label}: ', coalesce(cast({c} as varchar), '-'))" for label, c in BOUNDARY_PARTS)}, concat('Questions:', chr(10), 'none given')) as prompt
  from ({context})) group by all""",
        "cut_blocks": off + _BLOCKS + " select sheet_id, source_order, detected_marker, cast(source_start as int) as source_start, cast(source_end as int) as source_end, text from blocks",
        "cut_blocks_exploded": off + _BLOCKS + " select sheet_id, source_order, detected_marker, cast(source_start as int) as source_start, cast(source_end as int) as source_end, text from blocks",
        "merge_adjacent_exploded": on + " select sheet_id, source_order, resolved_question_id, source_start, source_end, confidence, status, text from merged",
        "strong_only_blocks": strong_only + _BLOCKS + " select sheet_id, source_order, detected_marker, text from blocks",
        "prefix_blocks": off + _BLOCKS + " select sheet_id, text from blocks where source_order = 1 and detected_marker is null",
        "structureless_docs": off + _BLOCKS + " select sheet_id, coalesce(structureless, false) as structureless from shape",
        "mapping_context": on + f""" select sheet_id, source_order as pos, text as block, detected_marker as marker, coalesce({mapped_before}, '') as mapped,
  array_to_string([i for i in {ids} if not coalesce(list_contains(string_split({mapped_before}, ','), i), false)], ',') as open_ids from resolved""",
        "merge_adjacent": on + " select sheet_id, source_order, resolved_question_id, source_start, source_end, confidence, status from ended_blocks",
        "answers_by_question": on + f""" select s.sheet_id, q.question_id, cast(count(e.text) as int) as n_answers, coalesce(string_agg(e.text, concat(chr(10), '--', chr(10)) order by e.source_order), '') as answers
  from norm s cross join {listed} left join ended_blocks e on e.sheet_id = s.sheet_id and e.resolved_question_id = q.question_id group by s.sheet_id, q.question_id""",
        "unmapped_distinct": on + ' select sheet_id, cast("at" as int) as "at", text from unmapped',
        "review_distinct": on + ' select sheet_id, cast("at" as int) as "at", text, possible from reviewed',
        "unadjudicated": off + _BLOCKS + _mapped(None, ids, config) + f" select sheet_id, cast({count('unmapped')} as int) as n_unmapped, cast({count('reviewed')} as int) as n_review from norm s",
        "accessors": on + f" select cast(sheet_id as varchar) as student_id, cast({count('reviewed')} as int) as n_review, cast({count('unmapped')} as int) as n_unmapped, 'success' as processing_status from norm s",
        "audit_counts": f"{on} {audit}",
        "debug_json": on + f""" select sheet_id, cast(to_json({{'student': cast(sheet_id as varchar), 'questions': {{{", ".join(f"'{i}': {answers(i)}" for i in ids)}}},
  'review': coalesce((select list({{'text': r.text, 'possible_questions': case when r.possible = '' then cast([] as varchar[]) else string_split(r.possible, ',') end}} order by r."at") from reviewed r where r.sheet_id = s.sheet_id), []),
  'unmapped': coalesce((select list(u.text order by u."at") from unmapped u where u.sheet_id = s.sheet_id), []),
  'audit': (select {{{", ".join(f"'{c}': a.{c}" for c in AUDIT)}}} from audit a where a.sheet_id = s.sheet_id),
  'processed_text': (select raw_text from sheets x where x.sheet_id = s.sheet_id), 'normalized_text': normalized}}) as varchar) as json from norm s""".replace(" select sheet_id, cast(to_json", f", audit as ({audit}) select sheet_id, cast(to_json", 1),
        "minimal_json": on + f""" select sheet_id, cast(to_json({{'student_id': cast(sheet_id as varchar), 'exam_id': '{config.exam_id}',
  'answers': coalesce((select list({{'question_id': q.question_id, 'answer': e.text}} order by q.ord, e.source_order) from ended_blocks e join {listed} on e.resolved_question_id = q.question_id where e.sheet_id = s.sheet_id), []),
  'unmapped_content': coalesce((select list({{'text': u.text}} order by u."at") from unmapped u where u.sheet_id = s.sheet_id), [])}}) as varchar) as json from norm s""",
    }


# The legacy grammar, spelled for an engine without look-around.
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NUMBER = r"[1-9]\p{Nd}*"
_STEM = rf"Q(?:UESTION)?{_WS}*(?:NO\.?|N)?{_WS}*"
_ASKS = rf"(?:In{_WS}+your{_WS}+own{_WS}+words,{_WS}*)?(?:Explain|Describe|Define|State|List|What{_WS}+is|What{_WS}+are|Why|How|When|Where|Who|Which)\b"


def _bare(x: str) -> str:
    """Without outer white space of any script."""
    return f"regexp_replace(regexp_replace({x}, '\\A{_WS}+', ''), '{_WS}+\\z', '')"


def _answered(x: str) -> str:
    """A leading prompt sentence goes unless nothing would remain."""
    rest = _bare(rf"regexp_replace({_bare(x)}, '(?i)\A{_ASKS}[^\n]*?[.!?](?:{_WS}|\z)', '')")
    return f"case when {rest} <> '' then {rest} else {_bare(x)} end"


def _next_marker(text: str) -> str:
    """struct<skipped, marker> of the first marker after a text's first character, which only stands before it; the character that must follow a marker is cut off where it is not the marker's own."""
    return rf"regexp_extract({text}, '(?is)\A(.*?[^A-Za-z0-9])(?:({_STEM}(?:{_NUMBER}|[IL]|[.:-])?)(?:{_WS}|\z|[.!?,;:)(\]])|({_NUMBER}{_WS}*[):.-])(?:{_WS}|\z))', ['skipped', 'stemmed', 'numbered'])"


def legacy(lines: str) -> dict[str, str]:
    """The legacy segmenter as a recursion from marker to marker, and the first marker of each line; ``lines`` are the common tables ``norm`` and ``lines``."""
    number, roman = f"regexp_extract(marker, '{_NUMBER}')", f"upper(regexp_extract(marker, '(?i)\\A{_STEM}([IL])\\z', 1))"
    raised = f"regexp_matches(marker, '(?i)\\A{_STEM}(?:[IL]|[.:-])\\z')"
    segments = rf"""with recursive {lines},
walk as (
  select sheet_id, normalized, 0 as k, 0 as start, 0 as stop, cast(0 as bigint) as at_number, cast(null as varchar) as question, false as ended from norm
  union all
  select sheet_id, normalized, k + 1, stop + length(m.skipped) - 1, stop + length(m.skipped) - 1 + length(marker), coalesce(n, at_number), concat('Q', cast(n as varchar)), m.skipped = '' from (
    select *, case when {number} <> '' then try_cast({number} as bigint) when {raised} then at_number + 1 end as n from (
      select *, concat(m.stemmed, m.numbered) as marker from (
        select *, {_next_marker("concat(case when stop = 0 then '|' else substr(normalized, stop, 1) end, substr(normalized, stop + 1))")} as m from walk where not ended)))
  where m.skipped <> ''),
marks as (select *, coalesce(lead(start) over (partition by sheet_id order by k), length(normalized)) as next from walk where k > 0 and question <> 'Q' and question is not null),
cut as (select sheet_id, k, question, {_bare("substr(normalized, stop + 1, next - stop)")} as raw, not contains(substr(normalized, start + 1, stop - start + 1), chr(10)) as same_line from marks),
cleaned as (select sheet_id, k, question, {_bare(f"regexp_replace(case when same_line then {_answered('raw')} else raw end, '{_WS}+', ' ', 'g')")} as answer from cut),
found as (select sheet_id, question, string_agg(answer, ' ' order by k) as answer, min(k) as k from cleaned where answer <> '' group by sheet_id, question)
select sheet_id, cast(row_number() over (partition by sheet_id order by k) - 1 as int) as "at", question, answer from found
union all select sheet_id, 0, 'UNKNOWN', case when normalized = '' then 'Entire OCR Text' when exists (select 1 from marks m where m.sheet_id = n.sheet_id) then normalized else {_bare(f"regexp_replace(normalized, '{_WS}+', ' ', 'g')")} end
from norm n where not exists (select 1 from found f where f.sheet_id = n.sheet_id)"""
    label = f"case when {number} <> '' then {number} else {roman} end"
    of_lines = rf"""with {lines},
own as (select sheet_id, {_bare("line_text")} as line from lines),
first as (select *, {_next_marker("concat('|', line)")} as m from own where line <> ''),
told as (select *, concat(m.stemmed, m.numbered) as marker from first)
select sheet_id, line, case when m.skipped = '' then null when {label} in ('I', 'L') then 'Q1' else concat('Q', {label}) end as question,
  case when m.skipped = '' then '' else {_answered("substr(line, length(m.skipped) + length(marker))")} end as rest, m.skipped <> '' as is_question from told"""
    return {"legacy_segments": segments, "question_lines": of_lines}


def parsed(replies: str) -> str:
    """Fields of raw replies (sheet_id, pos, reply) by JSON functions: fences go, or the first flat object with a decision counts."""

    def field(name: str) -> str:
        return f"v->>'$.{name}' as {name}, json_type(v, '$.{name}') as {name}_kind"

    def boolean(x: str) -> str:
        low = f"lower({_bare(x)})"
        return f"""case when {x}_kind = 'BOOLEAN' then {x} = 'true' when {x}_kind in ('UBIGINT', 'BIGINT', 'DOUBLE') then case try_cast({x} as double) when 1 then true when 0 then false end
      when {x}_kind = 'VARCHAR' then case when {low} in ('true', '1') then true when {low} in ('false', '0') then false end end"""

    names = ("decision", "question_id", "confidence", "requires_human_review", "needs_human_review", "subject_match", "subject_compat")
    return rf"""with r as ({replies}),
bare as (select sheet_id, pos, case when starts_with({_bare("reply")}, '```') then {_bare(f"regexp_replace({_bare('reply')}, '(?i)^```(?:json)?{_WS}*|{_WS}*```$', '', 'g')")} else {_bare("reply")} end as t from r),
value as (select sheet_id, pos, case when json_valid(t) then t::json else list_filter(regexp_extract_all(t, '(?s)\{{.*?\}}'), lambda x: json_valid(x) and json_type(case when json_valid(x) then x else '0' end, '$.decision') is not null)[1]::json end as v from bare),
fields as (select sheet_id, pos, coalesce(json_type(v) = 'OBJECT', false) as parsed, {", ".join(field(x) for x in names)} from value)
select sheet_id, pos, parsed, case when parsed and decision_kind is not null then decision else 'ambiguous' end as decision, question_id,
  case when not parsed or confidence_kind is null then 0 when confidence_kind in ('UBIGINT', 'BIGINT', 'DOUBLE', 'VARCHAR') then try_cast({_bare("confidence")} as double) end::double as confidence,
  case when not parsed then true when requires_human_review is not null then {boolean("requires_human_review")} when needs_human_review_kind is not null then {boolean("needs_human_review")} else false end as requires_human_review,
  case when subject_match is not null then {boolean("subject_match")} else {boolean("subject_compat")} end as subject_match from fields"""
