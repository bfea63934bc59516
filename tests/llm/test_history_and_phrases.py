"""Exact deduplication, late overwrite and phrase mining against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from markscribe.llm import dedup, late, phrases, queries

SF = "/root/testdata/sf0.001"


# --- exact deduplication -------------------------------------------------------------------------


def brute_dedup(rows):
    """Sorted (doc_id, keep_id, group_size, kept, text_sha256) of (doc_id, text) rows, in reading order."""
    groups = defaultdict(list)
    for at, (i, text) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i or 0, at, i))
    out = []
    for text, own in groups.items():
        first = min(own)
        out += [(x[4], first[4], len(own), x is first, hashlib.sha256(text.encode()).hexdigest()) for x in own]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_exact_dedup_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(queries.op11_exact_dedup(spark, SF)) == brute_dedup([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_exact_dedup_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "ab"), (5, "ab"), (6, "a  b"), (7, "a b"), (None, "ab"), (None, "alone"), (8, "A b"), (9, "é ü"), (9, "éü"), (10, "z " * 100_000), (10, "z" * 100_000)]
    docs = spark.createDataFrame([(i, t, "x", 1, True) for i, t in rows], "doc_id long, text string, digest string, group_size int, old boolean").coalesce(1)
    for history in (dedup.hashed_half(), F.lit(True), F.lit(False), F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))):
        assert found(dedup.deduplicate(docs, history)) == brute_dedup(rows)
    assert dedup.deduplicate(docs.limit(0), F.lit(True)).collect() == []


def test_exact_dedup_of_a_large_group(spark):
    rows = [(i, "the same  text") for i in range(4000)] + [(9000 + i, f"text {i % 1500}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup.deduplicate(docs, dedup.hashed_half())) == brute_dedup(rows)


def test_perfect_hash_is_minimal_and_bytes_decide():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        held = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        perfect = dedup.PerfectHash.of(held)
        slots = perfect.slots(held)
        assert sorted(slots) == list(range(n))
        assert len(perfect.bits) <= 5 * n + 64
        in_order = np.empty_like(held)
        in_order[slots] = held
        near = held.copy()
        near[:, 31] ^= 1
        assert (dedup.members(perfect, in_order, held) == slots).all()
        assert (dedup.members(perfect, in_order, near) == -1).all()
    some = perfect.slots(rng.integers(0, 256, (1000, 32), dtype=np.uint8))
    assert (some >= 0).any()  # the hash alone takes strangers for members


def test_merge_tells_members_from_arrivals(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b b")], "doc_id long, text string")
    new = spark.createDataFrame([(0, "b b"), (3, "c"), (4, "a ")], "doc_id long, text string")
    index = dedup.build_index(dedup.grouped(dedup.digests(old)), 3)
    merged = dedup.merge(dedup.grouped(dedup.digests(new).withColumn("row", F.col("row") + 1000)), index, 3)
    assert sorted((r.keep_id, r.group_size, r.known) for r in merged.collect()) == [(0, 2, True), (3, 1, False), (4, 2, True)]
    again = dedup.merge(dedup.grouped(dedup.digests(new)).limit(0), dedup.build_index(merged, 3), 3)
    assert sorted((r.keep_id, r.group_size) for r in again.collect()) == [(0, 2), (3, 1), (4, 2)]


# --- late overwrite ------------------------------------------------------------------------------

EPOCH = datetime(1970, 1, 1)


def day_of(row):
    return -1 if row["sold_at"] is None else (row["sold_at"] - EPOCH).days


def micros(at):
    return "" if at is None else str((at - EPOCH) // timedelta(microseconds=1))


def brute_layout(rows, size):
    """{(day, file_no): rows} of the latest-arrived rows."""
    rank = lambda r: [(r[c] is not None, r[c] or 0) if c != "status" else (r[c] is not None, r[c] or "") for c in ("arrived_at", "sold_at", "client_id", "status", "total", "priority")]
    kept = {}
    for r in rows:
        if r["sale_id"] not in kept or rank(r) > rank(kept[r["sale_id"]]):
            kept[r["sale_id"]] = r
    days = defaultdict(list)
    for r in kept.values():
        days[day_of(r)].append(r)
    out = {}
    for d, own in days.items():
        own.sort(key=lambda r: (r["sold_at"] or EPOCH, r["sale_id"] is not None, r["sale_id"] or 0))
        for k in range(0, len(own), size):
            out[d, k // size] = own[k : k + size]
    return out, kept


def brute_late(sales, cutoff=datetime(2024, 3, 20), files=1100):
    size, rows = 1 + len(sales) // files, []
    for r in sales:
        rows.append(r)
        h = None if r["sale_id"] is None else zlib.crc32(str(r["sale_id"]).encode())
        if h is not None and h % 3 == 0 and day_of(r) % 4 == 0:
            later = r["arrived_at"] and r["arrived_at"] + timedelta(days=1 + h % 97)
            rows.append(r | {"total": None if r["total"] is None else r["total"] + 1, "sold_at": r["sold_at"] + timedelta(days=h % 2), "arrived_at": later})
    early = [r["arrived_at"] is not None and r["arrived_at"] < cutoff for r in rows]
    start, stood = brute_layout([r for r, e in zip(rows, early, strict=True) if e], size)
    last, kept = brute_layout(rows, size)
    touched = set()
    for r, e in zip(rows, early, strict=True):
        if not e and kept[r["sale_id"]] is r:
            touched.add(day_of(r))
            if r["sale_id"] in stood:
                touched.add(day_of(stood[r["sale_id"]]))
    out = set()
    for (d, k), own in last.items():
        line = lambda r: f"{'' if r['sale_id'] is None else r['sale_id']}:{micros(r['sold_at'])}:{micros(r['arrived_at'])}"
        cents = sum(0 if r["total"] is None else math.floor(100 * r["total"] + 0.5) for r in own)
        ids = ",".join("" if r["sale_id"] is None else str(r["sale_id"]) for r in own)
        out.add((d, k, len(own), cents, sum(zlib.crc32(line(r).encode()) for r in own), hashlib.sha256(ids.encode()).hexdigest(), d in touched))
    return out, {x for x in start if x[0] not in touched}


def files_of(df):
    return {(r.day, r.file_no, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in df.collect()}


def local(path):
    return re.sub("^file:/+", "/", path)


def test_late_overwrite_against_brute_force(spark):
    sales = spark.read.parquet(f"{SF}/sales.parquet")
    got = queries.op12_late_overwrite(spark, SF).cache()
    want, untouched = brute_late([r.asDict() for r in sales.collect()])
    assert files_of(got) == want and untouched == {(r.day, r.file_no) for r in got.filter("not rewritten").collect()}
    rows = got.collect()
    assert all(pq.read_schema(local(r.path)).names == sales.columns and r.columns == ",".join(sales.columns) for r in rows)
    import glob

    top = local(rows[0].path).rsplit("/day=", 1)[0]
    assert sorted(glob.glob(f"{top}/**/*.parquet", recursive=True)) == sorted(local(r.path) for r in rows)
    assert not glob.glob(f"{top}-stage")


SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"


def odd_sales():
    rng, t0, out = random.Random(5), datetime(2024, 1, 1), []
    for i in range(300):
        sold = None if i % 11 == 0 else t0 + timedelta(days=rng.randrange(12), hours=rng.randrange(3))
        arrived = None if i % 13 == 0 else t0 + timedelta(days=rng.randrange(100), seconds=rng.randrange(3))
        out.append((None if i % 29 == 0 else rng.randrange(120), i % 7 or None, None if i % 5 == 0 else "done", None if i % 17 == 0 else rng.randrange(100000) / 100, sold, arrived, i % 3 or None))
    return out + out[:20]


def test_late_overwrite_of_odd_rows(spark):
    sales = spark.createDataFrame(odd_sales(), SALES)
    want, _ = brute_late([r.asDict() for r in sales.collect()], datetime(2024, 2, 1), 40)
    assert files_of(late.overwritten_sales(spark, sales, datetime(2024, 2, 1), 40)) == want
    for cutoff in (datetime(2020, 1, 1), datetime(2030, 1, 1)):  # all late; only rows without an arrival late
        want, _ = brute_late([r.asDict() for r in sales.collect()], cutoff, 7)
        assert files_of(late.overwritten_sales(spark, sales, cutoff, 7)) == want
    assert late.overwritten_sales(spark, sales.limit(0)).collect() == []
    with pytest.raises(ValueError, match="file_no"):
        late.overwritten_sales(spark, sales.withColumn("file_no", F.lit(1)))
    more = sales.withColumn("bits", F.lit("x")).withColumn("block", F.lit(2))
    assert late.overwritten_sales(spark, more, datetime(2024, 2, 1), 40).select("columns").distinct().collect()[0][0].endswith("priority,bits,block")


def test_days_without_late_rows_stay_byte_identical(spark, tmp_path):
    t = lambda d, h=0: datetime(2024, 1, d, h)
    early = spark.createDataFrame([(i, 1, "a", 1.0, t(1 + i % 4, i % 5), t(5), 1) for i in range(40)], SALES)
    path = str(tmp_path / "layout")
    late.write_files(late.cut_days(late.latest(early), 3), path)
    digest = lambda: {p.relative_to(path): hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.rglob("*.parquet")}
    before = digest()
    # sale 0 moves from day 1 to a day of its own, sale 5 (day 2) arrives again but earlier, sales 2, 6, ... empty day 3
    new = [(0, 1, "b", 2.0, t(9), t(6), 1), (5, 1, "b", 2.0, t(2), t(4), 1)] + [(i, 1, "b", 2.0, t(9), t(6), 1) for i in range(2, 40, 4)]
    days = late.overwrite_late(path, spark.createDataFrame(new, SALES), 3)
    assert days == [(t(d) - EPOCH).days for d in (1, 3, 9)]
    after = digest()
    names = {str(p).split("/")[0] for p in after}
    assert f"day={days[1]}" not in names and f"day={days[2]}" in names
    untouched = {p: h for p, h in before.items() if not any(str(p).startswith(f"day={d}/") for d in days)}
    assert untouched and untouched.items() <= after.items()
    rows = late.read_layout(spark, path, early.schema).collect()
    assert len(rows) == 40 and sum(r.status == "b" for r in rows) == 11
    assert late.overwrite_late(path, early.limit(0), 3) == []


def test_moves_can_be_repeated(spark, tmp_path):
    one = spark.createDataFrame([(1, 1, "a", 1.0, datetime(2024, 1, 1), datetime(2024, 1, 1), 1)], SALES)
    path, stage = str(tmp_path / "layout"), str(tmp_path / "layout-stage")
    late.write_files(late.cut_days(one, 3), path)
    late.write_files(late.cut_days(one.withColumn("status", F.lit("b")), 3), stage)
    days = [r.day for r in one.select(late.day().alias("day")).collect()]
    late._swap(spark, path, stage, days)
    late._swap(spark, path, stage, days)  # as after a failure
    assert [r.status for r in late.read_layout(spark, path, one.schema).collect()] == ["b"]


# --- phrases -------------------------------------------------------------------------------------


def brute_phrases(rows, least=30, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate({k: k + 32 for k in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i : i + k] for p, b in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * b >= 80 * candidates[p[i : i + k]]}
        rated = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), l, r))
        out |= {(lang, k, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for k, x in enumerate(sorted(rated)[:top], 1)}
    return out


def mined(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def test_phrases_against_brute_force(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert mined(queries.op13_phrase_mining(spark, SF)) == brute_phrases(rows) != set()


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    words = ["a", "B", "ça", "日本", "x y", "w" * 300, "NEW", "york", "city"]
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", " , "]) for _ in range(rng.randrange(60)))) for _ in range(150)]
    rows += [("en", "new york city " * 2000), ("en", None), (None, ""), ("en", " .,; "), ("de", "ends"), ("de", "here")]
    return rows + rows[:30]


def test_phrases_of_odd_texts(spark, odd_texts):
    docs = spark.createDataFrame([(t, g, 1) for g, t in odd_texts], "text string, lang string, f int")
    assert mined(phrases.mine(docs)) == brute_phrases(odd_texts)
    assert phrases.mine(docs.limit(0)).collect() == []


@pytest.mark.parametrize("most", [1, 1 << 21])
def test_phrases_by_filter_in_slices_and_cut_off(spark, odd_texts, most, monkeypatch):
    """A Bloom filter instead of hashes, small slices, and fewer ranks than phrases give what brute force gives."""
    monkeypatch.setattr(phrases, "MOST", most)
    monkeypatch.setattr(phrases, "BITS", 1 << 15)
    monkeypatch.setattr(phrases, "SLICE", 500)
    docs = spark.createDataFrame(odd_texts, "lang string, text string")
    assert mined(phrases.collocations(phrases.levels(docs, least=5), top=7)) == brute_phrases(odd_texts, 5, 7)


def test_later_passes_emit_only_grams_of_frequent_parts(spark, odd_texts):
    docs = spark.createDataFrame(odd_texts, "lang string, text string")
    tables = phrases.levels(docs, least=60)
    known = [spark.sparkContext.broadcast(phrases.frequent(t, k)) for k, t in enumerate(tables[:3], 1)]
    often = {(r.lang, r.phrase) for t in tables for r in t.collect()}
    for k in (2, 3, 4):
        for r in phrases.counted(docs, k, known[: k - 1]).collect():
            words = r.phrase.split(" ")
            assert {(r.lang, " ".join(words[:-1])), (r.lang, " ".join(words[1:]))} <= often
