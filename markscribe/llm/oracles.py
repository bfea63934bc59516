"""DuckDB SQL for the rows of the queries that SQL can express: joins, scans, formatting and archives.

The others are held by tests: tokenizers, hashed models, template deduction and approximate search
have no SQL.
"""

from __future__ import annotations

from markscribe.llm.chat import CONTROL, END, START, TRAINED
from markscribe.llm.jaccard import PERCENT, WORDS
from markscribe.llm.secret_scan import BASE_RULES, MORE_RULES

JACCARD = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) >= {WORDS} then list_distinct([array_to_string(w[i : i + {WORDS - 1}], ' ') for i in range(1, len(w) - {WORDS - 2})])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
sizes as (select doc_id, len(s) as n from sets),
each as (select doc_id, unnest(s) as g from sets),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) as c from each x join each y on x.g = y.g and x.doc_id < y.doc_id group by all),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= {PERCENT} * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a),
least_id as (select a, min(b) as b from reach group by a)
select doc_id, n as n_shingles, coalesce(least(doc_id, l.b), doc_id) as component_id from sizes left join least_id l on l.a = doc_id
"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Patterns as SQL has them, in the order of the rules: where letters match in either case, only ASCII ones do.
_PATTERNS = [
    (f"({_either_case('password|passwd|secret|token|api_?key')})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    *((rule.pattern, rule.group, rule.least) for rule in (*BASE_RULES[1:], *MORE_RULES)),
]
_KINDS = [rule.kind for rule in (*BASE_RULES, *MORE_RULES)]


def _hits(k: int) -> str:
    pattern, group, least = _PATTERNS[k]
    length = lambda strings: f"coalesce(list_sum([length(x) for x in {strings}]), 0)"
    return f"""select doc_id, {k} as k, '{_KINDS[k]}' as kind, start, start + length(hits[i]) as stop from (
  select *, {length("parts[1 : i]")} + {length("hits[1 : i - 1]")} as start from (
    select *, unnest(range(1, len(hits) + 1)) as i from (
      select doc_id, string_split_regex(text, '{pattern}') as parts, regexp_extract_all(text, '{pattern}') as hits, regexp_extract_all(text, '{pattern}', {group}) as own
      from docs where regexp_matches(text, '{pattern}')))) where length(own[i]) >= {least}"""


_LISTED = "string_agg(concat(kind, ':', cast(start as bigint), ':', cast(stop as bigint)), ',' order by start, k)"
SECRETS = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
hits as ({" union all ".join(_hits(k) for k in range(len(_PATTERNS)))}),
found as (
  select doc_id, {", ".join(f"count(*) filter (k = {k}) as n_{_KINDS[k]}" for k in range(len(BASE_RULES)))},
    {_LISTED} filter (k < {len(BASE_RULES)}) as base, {_LISTED} as spans from hits group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join found using (doc_id)
"""


def _escaped(column: str) -> str:
    out = f"replace({column}, '~', '~0')"
    for control in CONTROL:
        out = f"replace({out}, '{control}', '{('~1' if control[0] == '<' else '~2') + control[1:]}')"
    return out


CHAT = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, case when conv_id is null then row_number() over () end as alone from conversations
  union all select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]', null), (-1, 1, '{TRAINED}', '</s>[INST] ok [/INST]', null)))
select conv_id, count(*) as n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = '{TRAINED}'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = '{TRAINED}'), '')) as loss_sha256,
  cast(sum({len(START) + 1 + len(END)} + length(replace({_escaped("role")}, chr(10), '~3')) + length({_escaped("text")})) as bigint) as formatted_chars
from rows group by conv_id, alone
"""

WARC = """
with rows as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
first as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as target from rows)
select page_id, payload_bytes, payload_digest, case when target is null or target = page_id then 'response' else 'revisit' end as record_type,
  case when target <> page_id then target end as refers_to from first
"""

ORACLES = {
    "op1_ngram_jaccard_join": JACCARD,
    "op5_secret_scans": SECRETS,
    "op6_chat_formatting": CHAT,
    "op7_warc": WARC,
}
