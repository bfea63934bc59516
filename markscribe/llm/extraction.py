"""Main-text extraction by equivalence classes of the tokens that pages of the same host share.

Tokens are structural tags, named by their path (``html/body/article``), and blocks of text under
such a path. A token's occurrence vector is its count on every different page of the host, folded
into an order-free fingerprint; tokens of equal vectors form an equivalence class. A class is valid
if it has two tokens or more and is on at least half of the host's pages and on ``LEAST_CONTENTS``;
copies of a page count once. Valid classes nest by their paths into the host's template; a block of
text in the class of a tag around it (it is there exactly when and as often as that tag) is template
if all text of its place is; a place that has any other text is a slot of data, and so are the flow of
the page and of the main slot: nothing is cut from them, however often it is there.

The main slot is the outermost template tag named article or main; without one it is the whole
page. From it the template's blocks are left out, and slots beside the article (menus, adverts and
the like), which only names tell from the article: fixed lists of tags and of words in class, id and
role. A class counts as such if all its words are in these lists or neutral, so ``related-posts`` is
beside and ``related-work`` or ``has-sidebar`` is not, on any block element; words around the outermost article or main
element do not put it beside. Where template blocks would be more than half of the host's text, the
pages are near copies of each other and their text is data. A page without its host's main slot uses
its own article or main element, else its body.

Text between block tags is one block: character references decoded, white space runs turned into one
space, trimmed; empty blocks are left out, the others joined by one line end.

Defined cases: null or empty html gives empty text; a null or odd URL has host ""; repeated rows are
extracted each; unclosed tags are closed by their parents' ends, an unclosed comment or script runs
to the end of the page; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import html as html_lib
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import forget, map_arrow, spread, written

_TAG = re.compile(r"<(?:(!--)|([!?])[^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z))")
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements that make paths, elements that end a block, elements of raw text.
STRUCTURE = frozenset("html body main article section div nav header footer aside form ul ol dl table figure details dialog".split())
BLOCKS = STRUCTURE | frozenset("head title p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figcaption hr address summary caption fieldset legend".split())
RAW = frozenset("script style template textarea iframe svg select button".split())
#: Elements and words of class, id or role that mark text beside the article, and words that say nothing.
BESIDE = frozenset("nav footer aside form dialog head title".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent notice notices gdpr alert "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside rail widget footer masthead topbar toolbar "
    "comment comments disqus replies respond reply share sharing social newsletter subscribe signup related recommended search pagination pager "
    "contentinfo complementary".split()
)
NEUTRAL_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons center col column container content form group header holder inner item items "
    "left link links list main media mobile outer page panel post posts primary region right row secondary section site slot stories text thread top "
    "unit wrap wrapper".split()
)
MAIN = ("article", "main")
#: Levels that a path names.
DEPTH = 64
#: Different pages of a host that a class must be on.
LEAST_CONTENTS = 3
TOKENS = "host long, tag long, text long, pages long, fingerprint long, chars long, path string"
_MASK = (1 << 64) - 1


@functools.lru_cache(4096)
def _names(attributes: str) -> tuple[tuple[str, ...], ...]:
    """The words of every class, id and role name."""
    found = " ".join(next(x for x in m.groups() if x is not None) for m in _NAME.finditer(attributes))
    parts = (re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) for name in found.split())
    return tuple(tuple(w for w in words if w and not w.isdigit()) for words in parts)


def _beside(tag: str, attributes: str, inside_main: bool) -> int:
    """2 for an element that is beside by its tag, 1 for one that is by a name, else 0."""
    if tag in BESIDE or (tag == "header" and not inside_main):
        return 2
    if not attributes or tag in ("html", "body", *MAIN):
        return 0
    return int(any(BESIDE_WORDS.intersection(words) and BESIDE_WORDS.union(NEUTRAL_WORDS).issuperset(words) for words in _names(attributes)))


def _label(tag: str, attributes: str, beside: int) -> str:
    """A path's part; it says whether the element is beside, so equal paths are alike."""
    words = sorted({w for words in _names(attributes) for w in words if w.isalpha()}) if attributes else []
    return ".".join([tag, *words[:4]]) + "!" * beside


@dataclass(slots=True)
class _Open:
    """An open element: its path, and of the elements up to it how many are beside by a name or a tag, how many by their tag, and how many were before the outermost article or main."""

    tag: str
    path: tuple[str, ...]
    beside: int
    by_tag: int
    before_main: int | None

    @property
    def inside_beside(self) -> bool:
        """Names count only from the outermost article or main on."""
        return self.by_tag > 0 or self.beside > (self.before_main or 0)


_TOP = _Open("", (), 0, 0, None)
#: Block elements that hold no other block, and those that one of their kind ends; they are open elements only if they are beside.
_LINES = frozenset("p h1 h2 h3 h4 h5 h6 summary caption legend".split())
_ITEMS = frozenset("li dt dd tr td th".split())


def blocks(page: str) -> list[tuple[tuple[str, ...], bool, str]]:
    """(path, beside, text) of every block of a page, empty ones left out, and (path, beside, "") where an element begins; elements nested deeper than DEPTH share a path."""
    out: list[tuple[tuple[str, ...], bool, str]] = []
    stack: list[_Open] = []
    tags: Counter[str] = Counter()
    text, at = [], 0

    def top() -> _Open:
        return stack[-1] if stack else _TOP

    def end_block() -> None:
        joined = " ".join(html_lib.unescape("".join(text)).split()) if text else ""
        text.clear()
        if joined:
            out.append((top().path, top().inside_beside, joined))

    def open_element(tag: str, attributes: str, own: int) -> None:
        last = top()
        path = (*last.path, _label(tag, attributes, own)) if len(last.path) < DEPTH else last.path
        before = last.beside if last.before_main is None and tag in MAIN else last.before_main
        stack.append(_Open(tag, path, last.beside + (own > 0), last.by_tag + (own > 1), before))
        tags[tag] += 1

    def close_top() -> str:
        tag = stack.pop().tag
        tags[tag] -= 1
        return tag

    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at : m.start()])
        at = m.end()
        if m[1]:
            close = page.find("-->", at)
            at = len(page) if close < 0 else close + 3
            continue
        if m[2]:
            continue
        tag = m[4].lower()
        if tag in RAW and not m[3]:
            if not m[5].rstrip().endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else len(page)
            text.append(" ")
            continue
        if tag not in BLOCKS:
            if tag == "br":
                text.append(" ")
            continue
        end_block()
        if not m[3] and (top().tag in _LINES or (tag in _ITEMS and top().tag == tag)):
            close_top()
        if m[3]:
            if tags[tag]:
                while close_top() != tag:
                    pass
        elif tag in STRUCTURE or tag in ("head", "title"):
            if tag not in ("html", "body", "head") or not tags[tag]:
                open_element(tag, m[5], _beside(tag, m[5], bool(tags["article"] or tags["main"])))
            out.append((top().path, top().inside_beside, ""))
        elif m[5] and (own := _beside(tag, m[5], True)):
            open_element(tag, m[5], own)
    end_block()
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _key(text: str) -> int:
    """64 bits that stand for a text, signed."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _mix(x: int) -> int:
    x &= _MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


def page_tokens(page: str) -> dict[tuple[str, str], list[int]]:
    """Per token (path, text; a tag has no text) its count and its characters that are not beside."""
    tokens: dict[tuple[str, str], list[int]] = {("", ""): [1, 0]}
    for path, beside, text in blocks(page):
        if not beside or not text:
            t = tokens.setdefault(("/".join(path), text), [0, 0])
            t[0] += 1
            t[1] += len(text)
    return tokens


def occurrence(content: int, count: int) -> int:
    """What a page adds to the fingerprint of a token that it holds ``count`` times."""
    x = _mix(content + count * 0x9E3779B97F4A7C15)
    return x - (1 << 64) if x >> 63 else x


def different_pages(pages: DataFrame) -> DataFrame:
    """host, content (64 bits), html: one row for each different page of a host; only repeated pages are shuffled."""
    rows = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), F.xxhash64(F.lit(1), F.col("html")).alias("content"), "html")
    again = written(rows.groupBy("host", "content").count().filter("count > 1").select("host", "content"), "copies")
    single = rows.join(again, ["host", "content"], "left_anti")
    copies = rows.join(again, ["host", "content"], "left_semi").dropDuplicates(["host", "content"])
    return single.unionByName(copies)


def host_tokens(pages: DataFrame) -> DataFrame:
    """One row per host and token with its fingerprint; text and paths stand as 64 bits, batches are combined before the shuffle."""

    def run(batch):
        found: dict[tuple[int, int, int], list] = {}
        for host, content, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tags: dict[str, int] = {}
            for (path, text), (count, chars) in page_tokens(page or "").items():
                if path not in tags:
                    tags[path] = _key(path)
                row = found.setdefault((host, tags[path], _key(text) if text else 0), [0, 0, 0, None if text else path])
                row[0] += 1
                row[1] ^= occurrence(content, count)
                row[2] += chars
        rows = [(*k, *v) for k, v in found.items()]
        if rows:
            kinds = [pa.int64()] * 6 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in TOKENS.split(", ")])

    parts = map_arrow(different_pages(pages), run, TOKENS)
    return parts.groupBy("host", "tag", "text").agg(F.sum("pages").alias("pages"), F.bit_xor("fingerprint").alias("fingerprint"), F.sum("chars").alias("chars"), F.max("path").alias("path"))


def host_templates(tokens: DataFrame) -> DataFrame:
    """One row per host: ``main`` (path of the main slot, null for the whole page) and ``fixed`` (text tokens of the template).

    Tokens that fewer than half of a host's pages have are no template; that bounds a host's
    template by twice its mean number of tokens per page.
    """
    rows = tokens.select(*tokens.columns, (F.col("path") == "").alias("page"))
    whole = rows.groupBy("host").agg(F.max(F.when(F.col("page"), F.col("pages"))).alias("all_pages"), F.sum("chars").alias("all_chars"))
    often = rows.join(whole, "host").filter((F.col("pages") >= LEAST_CONTENTS) & (2 * F.col("pages") >= F.col("all_pages")))
    classes = often.groupBy("host", "fingerprint", "pages").agg(F.count("*").alias("size"))
    valid = often.join(classes.filter("size > 1"), ["host", "fingerprint", "pages"])
    tags = valid.filter("path is not null").select("host", "tag", "fingerprint", "pages", "path")
    depth = F.size(F.split("path", "/"))
    last = F.element_at(F.split("path", "/"), -1)
    named = tags.filter(last.rlike(rf"^(?:{'|'.join(MAIN)})(?:$|[.])") & ~F.contains("path", F.lit("!!")))
    main = named.groupBy("host").agg(F.max_by("path", F.struct(-depth, "pages", "path")).alias("main"))
    around = tags.select("host", "fingerprint", "pages", F.col("path").alias("outer"))
    places = rows.filter("path is not null").select("host", "tag", F.col("path").alias("place"))
    texts = valid.filter("path is null").join(places, ["host", "tag"]).join(around, ["host", "fingerprint", "pages"])
    nested = (F.col("outer") == "") | (F.col("outer") == F.col("place")) | F.startswith("place", F.concat("outer", F.lit("/")))
    bare = F.col("place").rlike(r"^(?:html)?/?(?:body)?$") | F.coalesce(F.col("place") == F.col("main"), F.lit(False))
    fixed = texts.filter(nested).join(main, "host", "left").filter(~bare).select("host", "all_chars", "tag", "text", "chars").distinct()
    # a place with any text that is not template is a slot of data, and nothing is cut from it
    held = rows.filter("path is null").groupBy("host", "tag").agg(F.count("*").alias("held"))
    alike = fixed.groupBy("host", "tag").agg(F.count("*").alias("held"))
    fixed = fixed.join(held.join(alike, ["host", "tag", "held"]), ["host", "tag"], "left_semi")
    fixed = fixed.groupBy("host", "all_chars").agg(F.sum("chars").alias("gone"), F.array_sort(F.collect_list(F.struct("tag", "text"))).alias("fixed"))
    fixed = fixed.filter("2 * gone <= all_chars").select("host", "fixed")
    return whole.select("host").join(main, "host", "left").join(fixed, "host", "left").filter("main is not null or fixed is not null")


def extract_text(page: str | None, main: str | None = None, fixed: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The text of a page's main slot under its host's template."""
    found = [("/".join(p), p, text) for p, beside, text in blocks(page or "") if text and not beside]
    under = lambda path, top: path == top or path.startswith(top + "/")
    if not (main and any(under(j, main) for j, _, _ in found)):
        main = next((j for j, p, _ in found if p and re.split(r"[.!]", p[-1])[0] in MAIN), None)
        if main is None:  # an element around the page's text
            main = next(("/".join(p[: i + 1]) for _, p, _ in found for i, label in enumerate(p) if re.split(r"[.!]", label)[0] in MAIN), None)
    own = [(j, text) for j, _, text in found if main is None or under(j, main)]
    kept = [text for j, text in own if not fixed or (_key(j), _key(text)) not in fixed]
    return "\n".join(kept or [text for _, text in own])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages(page_id, url, html)``."""
    pages = spread(pages.select(F.col("page_id").cast("long"), "url", "html"))
    tokens = written(host_tokens(pages), "host-tokens")
    templates = written(host_templates(tokens), "templates")  # its size decides how Spark joins
    forget(tokens)
    rows = pages.withColumn("host", F.xxhash64(host_of(F.col("url")))).join(templates, "host", "left")

    def run(batch):
        texts, sets = [], {}
        for html, host, main, fixed in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
            if host not in sets:
                sets[host] = frozenset((x["tag"], x["text"]) for x in fixed or [])
            texts.append(extract_text(html, main, sets[host]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_arrow(rows.select("page_id", "url", "html", "host", "main", "fixed"), run, "page_id long, url string, text string")
