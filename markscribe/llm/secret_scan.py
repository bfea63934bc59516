"""Secret scans: a trigram inverted index with Boolean trigram queries derived from each rule.

Per batch of documents every document is indexed by the lower-cased ASCII trigrams that some rule
asks for; a rule's query (AND/OR over trigrams) intersects and unites the postings, and only the
candidates are verified with the rule's regular expression. A rule without mandatory trigrams
(``hex``) scans every document. The batch is the unit of indexing, so memory is bounded and a lost
executor costs its batches only.

Defined cases: null text is empty; an empty text has no spans; repeated rows are scanned each;
columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import map_arrow, utf8_slices


@dataclass(frozen=True)
class Rule:
    """A kind, its expression, the group whose length counts, and the least length (code points)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str):
        for m in _compiled(self.pattern).finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.start(), m.end()


BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: What the method adds: published credential formats with a fixed prefix.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
_CACHE: dict[str, re.Pattern] = {}


def _compiled(pattern: str) -> re.Pattern:
    if pattern not in _CACHE:
        _CACHE[pattern] = re.compile(pattern, re.ASCII)
    return _CACHE[pattern]


# --- from an expression to a Boolean trigram query ---------------------------------------------
# A query is True (anything), ("and", {…}) or ("or", {…}) over trigrams (str) and queries.

_MOST_STRINGS = 64


def _all_of(parts) -> object:
    parts = frozenset(p for p in parts if p is not True)
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _any_of(parts) -> object:
    parts = frozenset(parts)
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _of_strings(strings) -> object:
    return _any_of(_all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _strings(item) -> set[str] | None:
    """All lower-case strings that one parsed item can match, if they are few."""
    op, arg = item
    if op is C.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if op is C.IN:
        found: set[str] = set()
        for o, a in arg:
            if o is C.LITERAL and a < 128:
                found.add(chr(a).lower())
            elif o is C.RANGE and a[1] < 128 and a[1] - a[0] < 8:
                found |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is C.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is C.BRANCH:
        each = [_sequence_strings(x) for x in arg[1]]
        return None if any(x is None for x in each) else set().union(*each)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] is not C.MAXREPEAT and arg[1] <= 2:
        once = _sequence_strings(arg[2])
        if once is not None:
            found = {""} if arg[0] == 0 else set()
            for k in range(max(1, arg[0]), arg[1] + 1):
                many = {""}
                for _ in range(k):
                    many = {a + b for a in many for b in once}
                found |= many
            return found if len(found) <= _MOST_STRINGS else None
    if op is C.AT:
        return {""}
    return None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for item in items:
        more = _strings(item)
        if more is None or len(out) * len(more) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(items) -> object:
    """The query of a sequence: runs of enumerable items give strings; others give their own queries."""
    parts, run = [], {""}
    for item in items:
        more = _strings(item)
        if more is not None and len(run) * len(more) <= _MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_of_strings(run))
        run = more if more is not None else {""}
        if more is None:
            op, arg = item
            if op is C.SUBPATTERN:
                parts.append(_query(arg[-1]))
            elif op is C.BRANCH:
                parts.append(_any_of(_query(x) for x in arg[1]))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
                parts.append(_query(arg[2]))
    return _all_of([*parts, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every match of ``pattern`` satisfies; True if it has none."""
    return _query(P.parse(pattern))


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(x) for x in query[1]))


def _lookup(query: object, postings: dict[str, set[int]], n: int) -> set[int]:
    if query is True:
        return set(range(n))
    if isinstance(query, str):
        return postings.get(query, set())
    found = [_lookup(x, postings, n) for x in query[1]]
    return set.intersection(*found) if query[0] == "and" else set.union(*found)


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _postings(data: np.ndarray, offsets: np.ndarray, wanted: dict[int, str], table: np.ndarray) -> dict[str, set[int]]:
    """Documents by wanted trigram. Trigrams that cross documents are left out."""
    if len(data) < 3:
        return {}
    low = _LOWER[data]
    codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    at = np.flatnonzero(table[codes])
    doc = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 3 <= offsets[doc + 1]
    pairs = np.unique((codes[at][inside].astype(np.int64) << 32) | doc[inside])
    out: dict[str, set[int]] = {}
    for pair in pairs.tolist():
        out.setdefault(wanted[pair >> 32], set()).add(pair & 0xFFFFFFFF)
    return out


def scan_texts(column: pa.Array, rules=RULES) -> list[list[tuple[int, int, int]]]:
    """Per text its spans (start, end, rule number) in code points, by start then rule."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = {int.from_bytes(t.encode(), "big"): t for q in queries for t in trigrams(q)}
    table = np.zeros(1 << 24, dtype=bool)
    table[list(wanted)] = True
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
    for first, data, offsets in utf8_slices(column):
        n = len(offsets) - 1
        postings = _postings(data, offsets, wanted, table)
        texts: dict[int, str] = {}
        raw = data.tobytes()
        for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
            for i in _lookup(query, postings, n):
                if i not in texts:
                    texts[i] = raw[offsets[i] : offsets[i + 1]].decode()
                out[first + i] += [(a, b, k) for a, b in rule.spans(texts[i])]
    for spans in out:
        spans.sort(key=lambda s: (s[0], s[2]))
    return out


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Each row's key and ``spans`` array<struct<kind, start, end>> (code points, end exclusive)."""

    def run(batch):
        found = scan_texts(batch.column(1), rules)
        rows = [[{"kind": rules[k].kind, "start": a, "end": b} for a, b, k in spans] for spans in found]
        spans = pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pc.cast(batch.column(0), pa.int64()), spans], ["key", "spans"])

    return map_arrow(docs.select(F.col(key).cast("long"), text), run, "key long, spans array<struct<kind string, start long, end long>>").withColumnRenamed("key", key)


def redact(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``<kind>``; overlapping spans become one mark, other columns stay."""
    schema = docs.schema
    at = docs.columns.index(text)

    def run(batch):
        column = batch.column(at)
        texts = column.to_pylist()
        for i, spans in enumerate(scan_texts(column, rules)):
            if spans:
                parts, done = [], 0
                for a, b, k in spans:
                    if a >= done:
                        parts += [texts[i][done:a], f"<{rules[k].kind}>"]
                    done = max(done, b)
                texts[i] = "".join([*parts, texts[i][done:]])
        arrays = [pa.array(texts, column.type) if j == at else batch.column(j) for j in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return map_arrow(docs, run, schema)


def digest_columns(df: DataFrame) -> DataFrame:
    """The counts and digests of the query, derived from ``spans`` with SQL functions."""
    base = [r.kind for r in BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return df.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def brute_force(text: str | None) -> dict:
    """The query's row by scanning everything with every rule (tests)."""
    spans = sorted((a, k, b) for k, r in enumerate(RULES) for a, b in r.spans(text or ""))
    listed = [(RULES[k].kind, a, b) for a, k, b in spans]
    base = {r.kind for r in BASE_RULES}
    join = lambda rows: ",".join(f"{k}:{a}:{b}" for k, a, b in rows)
    return {f"n_{r.kind}": sum(x[0] == r.kind for x in listed) for r in BASE_RULES} | {
        "base_sha256": hashlib.sha256(join(x for x in listed if x[0] in base).encode()).hexdigest(),
        "spans": join(listed),
    }
