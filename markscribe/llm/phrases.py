"""Phrase collocations by Apriori passes over the words of each language.

Pass k counts k-grams. A task codes the words of a slice of whole texts exactly and codes longer grams
by pairs of overlapping shorter ones; from the second pass on it emits a gram only where both
(k-1)-grams in it are among the frequent ones of the pass before, which are broadcast. Emitted grams
are counted within the slice, then by Spark. The broadcast is bounded: up to MOST hashes of frequent
grams as they are, beyond that a Bloom filter of fixed size; what either lets through in vain is
counted and falls under the limit, so counts are exact at every size. Level tables then give the parts
of every cut.

Defined cases: a null text is empty, a null lang ``und``; repeated rows count as often as they are
there; words are never cut, pieces never cross documents; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markscribe.llm import common
from markscribe.llm.common import distinct_strings, map_arrow, mix, utf8_slices, word_spans, written

#: Fixed values of the contract.
CUTS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LEAST, LONGEST, TOP, WEIGHT, SHARE = 30, 4, 2000, 2_000_000, 80
#: Hashes of frequent grams that are broadcast as they are, and the bits of the filter beyond (16 MB each).
MOST, BITS = 1 << 21, 1 << 27
PROBES = 4
#: Bytes of text that a task works on at once, and grams that it hands over at once.
SLICE, EMIT = 1 << 21, 1 << 16

_CUT, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_CUT[list(CUTS)] = True
_BLANK[list(BLANKS)] = True


@dataclass
class Words:
    """Words of a slice, lower-cased: which string each one is, whether the next is in the same piece, and the distinct strings with their hashes."""

    codes: np.ndarray
    joined: np.ndarray
    data: np.ndarray
    at: np.ndarray
    hashes: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = common._LOWER[data]
    cut = _CUT[low]
    word = ~(cut | _BLANK[low])
    starts, ends = word_spans(word, offsets)
    piece = np.cumsum(cut, dtype=np.int32)[starts]
    document = np.searchsorted(offsets, starts, side="right")
    joined = (piece[1:] == piece[:-1]) & (document[1:] == document[:-1])
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    codes, data, at = distinct_strings(low[word], at)
    return Words(codes, joined, data, at, string_hashes(data, at))


def string_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings that lie one after another: a polynomial over the bytes, finalised with the length."""
    up, down = common._powers(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(common._BYTE_VALUES[data] * up[: len(data)], out=prefix[1:])
    return mix((prefix[at[1:]] - prefix[at[:-1]]) * down[at[:-1]] + np.diff(at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of keys in order of appearance, and where each code appears first."""
    codes, _ = pd.factorize(keys)
    return codes, np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)


def gram_hashes(words: Words, first: np.ndarray, k: int, salt: int) -> np.ndarray:
    """64-bit hashes of the k-grams that begin at these words."""
    h = np.full(len(first), salt, np.uint64)
    for i in range(k):
        h = mix(h + words.hashes[words.codes[first + i]])
    return h


def lang_salt(lang: str) -> int:
    """A number for each language that its grams' hashes are mixed with."""
    raw = np.frombuffer(lang.encode(), np.uint8)
    h = np.full(1, len(raw), np.uint64)
    for x in raw:
        h = mix(h + common._BYTE_VALUES[x])
    return int(h[0])


class Frequent:
    """The frequent grams of a level, as tasks ask for them: sorted hashes, or a Bloom filter."""

    def __init__(self, hashes: np.ndarray | None = None, bits: np.ndarray | None = None):
        self.hashes, self.bits = hashes, bits

    def has(self, h: np.ndarray) -> np.ndarray:
        if self.bits is None:
            at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
            return self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        out = np.ones(len(h), bool)
        for at in probes(h, 8 * len(self.bits)):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    step = mix(h) | np.uint64(1)
    return [((h + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64) for k in range(PROBES)]


def grams(words: Words, k: int, known: list[Frequent], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-grams of a slice that can be frequent: the word each begins at first, and its count."""
    n = len(words.codes)
    codes, first = coded(words.codes)
    places, joined = np.arange(n), np.append(words.joined, False)
    for level in range(2, k + 1):
        frequent = known[level - 2].has(gram_hashes(words, first, level - 1, salt))[codes]
        at = np.full(n + 1, -1, np.int64)
        at[places[frequent]] = codes[frequent]
        places = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & joined[:n])
        codes, found = coded(at[places] * (int(at.max(initial=0)) + 1) + at[places + 1])
        first = places[found]
    return first, np.bincount(codes, minlength=len(first))


def spelled(words: Words, first: np.ndarray, k: int) -> pa.Array:
    """The k-grams that begin at these words, their words joined by blanks."""
    parts = [pa.StringArray.from_buffers(len(words.at) - 1, pa.py_buffer(words.at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(words.data))).take(pa.array(words.codes[first + i])) for i in range(k)]
    return parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")


def rows_of(lang: str, phrases: pa.Array, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.repeat(lang, len(f)), phrases, pa.array(f, pa.int64())], ["lang", "phrase", "f"])


def counted(docs: DataFrame, k: int, known: list) -> DataFrame:
    """lang, phrase, f of all k-grams that can be frequent; at level 1 also the number of all words, as the phrase without a word."""

    def count(batch: pa.RecordBatch):
        langs = batch.column(0).dictionary_encode()
        sets = [b.value for b in known]
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).filter(pa.array(langs.indices.to_numpy() == code))
            for _, data, offsets in utf8_slices(texts, SLICE):
                words = words_of(data, offsets)
                first, f = grams(words, k, sets, lang_salt(lang))
                if k == 1:
                    yield rows_of(lang, pa.array([""]), np.array([len(words.codes)]))
                for at in range(0, len(f), EMIT):
                    yield rows_of(lang, spelled(words, first[at : at + EMIT], k), f[at : at + EMIT])

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def table_hashes(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """The hashes by which tasks know the phrases (lang, phrase) of a level table."""
    out = np.zeros(batch.num_rows, np.uint64)
    langs = batch.column(0).dictionary_encode()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        rows = np.flatnonzero(langs.indices.to_numpy() == code)
        for _, data, offsets in utf8_slices(batch.column(1).take(pa.array(rows)), 1 << 30):
            words = words_of(data, offsets)
            out[rows] = gram_hashes(words, np.arange(0, len(words.codes), k), k, lang_salt(lang))
    return out


def frequent(level: DataFrame, k: int) -> Frequent:
    """What is broadcast of a level table."""
    of = level.filter("phrase <> ''").select("lang", "phrase")
    if of.count() <= MOST:
        hashes = map_arrow(of, lambda b: [pa.RecordBatch.from_arrays([pa.array(table_hashes(b, k).view(np.int64))], ["h"])], "h long")
        return Frequent(hashes=np.sort(hashes.toArrow()["h"].to_numpy().view(np.uint64)))

    def places(batch: pa.RecordBatch):
        at = np.unique(np.concatenate(probes(table_hashes(batch, k), BITS)))
        yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    # blocks of 32,768 bits, set bit by bit where the grams are; BITS bounds what reaches the driver
    blocks = map_arrow(of, places, "at long").groupBy(F.expr("at div 32768").alias("block")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        bits[row.block * 4096 : (row.block + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    return Frequent(bits=bits)


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> list[DataFrame]:
    """The level tables (lang, phrase, f) of grams of 1 to ``longest`` words with f >= ``least``; the first also has the phrase without a word."""
    known, out = [], []
    for k in range(1, longest + 1):
        out.append(written(counted(docs, k, known).filter((F.col("f") >= least) | (F.col("phrase") == "")), f"grams{k}"))
        if k < longest:
            known.append(docs.sparkSession.sparkContext.broadcast(frequent(out[-1], k)))
    for b in known:
        b.unpersist()
    return out


def _wide(c: str):
    return F.col(c).cast("decimal(20,0)")


def collocations(tables: list[DataFrame], top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    words = tables[0].filter("phrase <> ''")
    total = tables[0].filter("phrase = ''").select("lang", F.col("f").alias("n"))
    grams = words
    for t in tables[1:]:
        grams = grams.unionByName(t)
    longer = tables[1].select("*", F.lit(2).alias("k"))
    for k, t in enumerate(tables[2:], 3):
        longer = longer.unionByName(t.select("*", F.lit(k).alias("k")))
    longer = longer.withColumn("w", F.split("phrase", " "))

    # the most frequent longer phrase around each
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " "))))
    around = longer.filter("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("around"))
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = longer.join(around, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (_wide("around") * 100 < _wide("f") * SHARE))

    cut = kept.select("lang", "phrase", F.col("f").alias("a"), "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"))
    cut = cut.join(grams.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(grams.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cut = cut.withColumn("score", F.expr(f"cast({WEIGHT} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    least = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    scored = least.select("lang", "phrase", "a", "m.l", "m.r", "m.score")

    # the first of parts of a language, then of those: no task sees a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = scored.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame) -> DataFrame:
    """Collocations of ``docs`` (lang, text)."""
    return collocations(levels(docs.select("lang", "text")))
