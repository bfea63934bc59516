"""Exact deduplication against a history: a minimal perfect hash over the digests known so far.

History and arrivals are reduced to rows of digest, length, id and row number; texts are read once
and never shuffled. The distinct digests of the history are dealt to shards by their own bits. Each
shard holds a minimal perfect hash (levels of bit arrays: a digest alone in its position stays there,
the others go to the next level) and, slot by slot, the full digest, the locator of the row that stays
and the group's size. An arriving digest is looked up in its shard and compared byte by byte with the
slot's; where they differ it is no member and forms a group of its own.

Defined cases: a null text counts as empty, all texts without other characters are one group; among
equal texts the longest original stays, then the smallest doc_id (null last), then the row read first,
so of fully repeated rows exactly one stays; an empty table gives an empty result and an index
without shards; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import forget, mix, written

GROUP = "digest binary, n_chars int, keep_id long, keep_row long, group_size long"
INDEX = "shard int, bits binary, sizes array<int>, digests binary, n_chars array<int>, keep_id array<long>, keep_row array<long>, group_size array<long>"
#: Digests of a shard, about; and shards for a partition, so that none gets many more than another.
SHARD, EVEN = 1 << 16, 8
#: A group with more than this share of all rows is joined by a broadcast: there are fewer such groups than this.
HOT = 1024
_STEP = 0x9E3779B97F4A7C15


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", "")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: row (unique), doc_id, n_chars (code points of the original), digest (SHA-256 of the normalised text)."""
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.length(text).alias("n_chars"), F.unhex(F.sha2(normalised(text), 256)).alias("digest"))


def grouped(rows: DataFrame) -> DataFrame:
    """GROUP of each distinct digest; map tasks pre-aggregate, so that a large group of copies is a row of each."""
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("id"), (-F.col("row")).alias("row"))).alias("best")
    groups = rows.groupBy("digest").agg(best, F.count("*").alias("group_size"))
    return groups.select("digest", "best.n_chars", (-F.col("best.id")).alias("keep_id"), (-F.col("best.row")).alias("keep_row"), "group_size")


# --- the minimal perfect hash --------------------------------------------------------------------


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view(np.uint64)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Positions of digests (rows of four 64-bit words) on a level; other words lead on every level."""
    h = words[:, level % 4] + np.uint64((_STEP * (level + 1)) % 2**64)
    for k in range(1, 4):
        h = mix(h) ^ words[:, (level + k) % 4]
    return (mix(h) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n-1 of n distinct digests; any other digest gets some slot or none."""

    def __init__(self, bits: np.ndarray, sizes: list[int]):
        self.bits, self.sizes = bits, sizes
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def of(cls, digests: np.ndarray) -> PerfectHash:
        left, bits, sizes = _words(digests), [], []
        while len(left):
            sizes.append(max(8, 2 * len(left)))
            at = _place(left, len(sizes) - 1, sizes[-1])
            alone = np.bincount(at, minlength=sizes[-1]) == 1
            bits.append(alone)
            left = left[~alone[at]]
        return cls(np.concatenate(bits) if bits else np.zeros(0, bool), sizes)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Each digest's slot, -1 where no level has one."""
        words, base = _words(digests), 0
        out, left = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, size in enumerate(self.sizes):
            at = base + _place(words[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of 32 bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def shard_count(n: int, partitions: int) -> int:
    return max(EVEN * partitions, -(-n // SHARD))


def shard(count: int) -> Column:
    """Of a digest, from its first four bytes."""
    return (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") * count / F.lit(1 << 32)).cast("int").alias("shard")


def _index_row(shard: int, groups: pa.Table) -> pa.Table:
    found = _matrix(groups["digest"])
    perfect = PerfectHash.of(found)
    order = np.empty(len(found), np.int64)
    order[perfect.slots(found)] = np.arange(len(found))
    in_order = groups.take(pa.array(order))
    lists = {c: pa.array([in_order[c].to_pylist()], pa.list_(kind)) for c, kind in (("n_chars", pa.int32()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64()))}
    head = {"shard": pa.array([shard], pa.int32()), "bits": pa.array([np.packbits(perfect.bits).tobytes()], pa.binary()), "sizes": pa.array([perfect.sizes], pa.list_(pa.int32())), "digests": pa.array([found[order].tobytes()], pa.binary())}
    return pa.table(head | lists)


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """INDEX over ``grouped`` rows, one row per shard that has any."""

    def build(key, table):
        return _index_row(key[0].as_py(), table)

    return groups.withColumn("shard", shard(shards)).groupBy("shard").applyInArrow(build, INDEX)


def _open(index: pa.Table) -> tuple[PerfectHash, np.ndarray, pa.Table]:
    """A shard's hash, the digests of its slots, and their groups."""
    row = index.to_pylist()[0] if len(index) else {"bits": b"", "sizes": [], "digests": b"", "n_chars": [], "keep_id": [], "keep_row": [], "group_size": []}
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
    found = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
    kinds = {"n_chars": pa.int32(), "keep_id": pa.int64(), "keep_row": pa.int64(), "group_size": pa.int64()}
    return PerfectHash(bits, row["sizes"]), found, pa.table({c: pa.array(row[c], kind) for c, kind in kinds.items()})


def members(perfect: PerfectHash, held: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Each digest's slot, if the slot's digest has the same bytes; -1 else."""
    slot = perfect.slots(digests)
    asked = np.flatnonzero(slot >= 0)
    slot[asked[(held[slot[asked]] != digests[asked]).any(axis=1)]] = -1
    return slot


def _rank(table: pa.Table) -> list[tuple]:
    """Sort keys by which the row that stays is the largest."""
    return [(c, i is not None, -(i or 0), -r) for c, i, r in zip(*(table[x].to_pylist() for x in ("n_chars", "keep_id", "keep_row")), strict=True)]


def merge(arrivals: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """GROUP and ``known`` (the history has the digest) of all groups after ``arrivals`` (``grouped`` rows) have met the index.

    A member adds to its slot's group and takes it over if its text is longer (ties: smaller id);
    other arrivals are groups of their own; slots that nobody asked for stay as they are.
    """

    def run(key, new, index):
        perfect, held, groups = _open(index)
        digests = _matrix(new["digest"])
        slot = members(perfect, held, digests)
        met = np.flatnonzero(slot >= 0)
        own, other = _rank(groups.take(pa.array(slot[met]))), _rank(new.take(pa.array(met)))
        better = np.array([a > b for a, b in zip(other, own, strict=True)], bool)
        # slot by slot: which row of [groups; arrivals] stays
        stays = np.arange(len(held))
        stays[slot[met[better]]] = len(held) + met[better]
        sizes = groups["group_size"].to_numpy().copy()
        sizes[slot[met]] += new["group_size"].to_numpy()[met]
        alone = np.flatnonzero(slot < 0)
        pick = pa.array(np.concatenate([stays, len(held) + alone]))
        both = pa.concat_tables([groups.select(["n_chars", "keep_id", "keep_row"]), new.select(["n_chars", "keep_id", "keep_row"])]).take(pick)
        digest = pa.array([x.tobytes() for x in held] + [x.tobytes() for x in digests[alone]], pa.binary())
        all_sizes = np.concatenate([sizes, new["group_size"].to_numpy()[alone]])
        known = np.arange(len(digest)) < len(held)
        return pa.table({"digest": digest, **{c: both[c] for c in both.column_names}, "group_size": pa.array(all_sizes, pa.int64()), "known": pa.array(known)})

    left = arrivals.withColumn("shard", shard(shards)).groupBy("shard")
    return left.cogroup(index.groupBy("shard")).applyInArrow(run, f"{GROUP}, known boolean")


def with_groups(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``digests`` rows with keep_id, group_size and kept; the few groups that hold a large share of the rows are broadcast, the others joined."""
    hot = F.col("group_size") > max(1, total // HOT)
    found = groups.select("digest", "keep_id", "keep_row", "group_size")
    large, small = F.broadcast(found.filter(hot)), found.filter(~hot)
    # a left semi and anti join on the same few digests parts the rows
    one = rows.join(large, "digest")
    other = rows.join(F.broadcast(found.filter(hot).select("digest")), "digest", "left_anti").join(small, "digest")
    return one.unionByName(other).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, history: Column) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``; rows for which ``history`` holds were there before the others arrived.

    ``history`` is an expression of doc_id that is never null.
    """
    spark = docs.sparkSession
    rows = written(digests(docs).withColumn("old", history), "digests")
    known = written(grouped(rows.filter("old")), "history")
    shards = shard_count(known.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = written(build_index(known, shards), "index")
    groups = written(merge(grouped(rows.filter("not old")), index, shards), "groups")
    forget(known, index)
    return with_groups(rows, groups, rows.count())


def hashed_half(doc_id: str = "doc_id") -> Column:
    """The half of the documents, by the CRC of the id, that a query over one table takes for its history."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 2 == 0
