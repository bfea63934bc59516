"""N-gram Jaccard join by PartEnum signatures.

Two documents link when 100 * |A and B| >= 75 * |A or B| over their sets of five-word shingles. All
links between different sets are found:

1. Sets. Words and shingles are hashed to 64 bits; documents of equal sets (128-bit digest) are one
   class with a number of its own, represented by its smallest (doc_id, text digest).
2. Support. A set that links with another shares at least 75 % of its shingles with it. Shingles are
   dealt to buckets, in packed blobs, and counted by class; classes with less than 75 % of shingles
   that some other class has cannot link and go no further.
3. Signatures. Sizes fall into bands in which a link stays in one band or crosses to the next. A band
   pair bounds the symmetric difference by k. The hash domain is cut into g groups of four parts; at
   most k // 2 groups hold two or more differences, so in another group three of four parts agree.
   Each three-part subset of each group is a signature. Empty subsets say nothing: they are left out
   unless a set has so few groups without one (at most k // 2) that the guarantee would not hold;
   only such sets exchange empty signatures, among themselves.
4. Candidates. Members of a signature form lists (equal lists are kept once). Members are compared
   with their list's smallest and largest first; links are merged to components. Where members of a
   signature are still in different components, finer keys decide which of its members are compared:
   a set's rarest shingles, of which links must share one early enough to reach the overlap that
   their sizes and support demand (prefix filter). Every comparison is exact.

Hot groups: copies collapse in 1. A shingle or signature that several sets of one map task share is
settled there and sent on once, so a bucket gets one entry of it for each map task, not for each
set: a signature's members are the lists of the map tasks, tied by a list of one member of each.
A component is never compared with itself, and joins on hubs and keys are plain shuffles that
adaptive execution can split. Sets that share early rare shingles with many others without linking
are compared with each of them, as their sizes and shingles leave no other way.

Defined cases: null or empty text has the empty set, 0 shingles, and is its own component; fewer
than five words are one shingle; rows that repeat an id are documents of their own with that id;
rows without an id link with none unless their set has one (else null component_id); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import forget, hash_words, map_arrow, map_batches, mix, spread, utf8_slices, written
from markscribe.llm.components import components

WORDS, PERCENT = 5, 75
PARTS = 4
#: More groups than the bound on bad ones, as a ratio, so that empty subsets can be left out.
SLACK = 1.5
#: Class ids that are broadcast at most; entries of a bucket and least entries of a map task's blobs.
MOST_BROADCAST, PER_BUCKET, LEAST_BLOB = 1 << 18, 1 << 20, 1 << 20
_SEEDS = [np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x8EBC6AF09C88C6E3, 0xD6D018F5A1B2C3D5)]
_LENGTH = np.uint64(0xA24BAED4963EE407)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per document the sorted distinct shingle hashes."""
    words, bounds = hash_words(data, offsets)
    seeds, lengths = np.array(_SEEDS), np.arange(WORDS, dtype=np.uint64) * _LENGTH
    n = len(words) - WORDS + 1
    rolled = sum((words[k : k + n] * seeds[k] for k in range(WORDS)), np.zeros(max(n, 0), np.uint64)) if n > 0 else np.zeros(0, np.uint64)
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            few = (words[a:b] * seeds[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(few + lengths[b - a : b - a + 1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    a = (mix(shingles ^ _SEEDS[0])).sum(dtype=np.uint64)
    b = (mix(shingles + _SEEDS[1])).sum(dtype=np.uint64)
    return int(mix(a[None])[0].view(np.int64)), int(mix(b[None])[0].view(np.int64))


def text_key() -> tuple:
    """128 bits, ``t1`` and ``t2``, that stand for a row's text."""
    text = F.col("text").cast("string")
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def set_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, t1, t2, n_shingles, d1, d2 of ``docs(doc_id, text)``."""

    def run(batch):
        rows = []
        for _, data, offsets in utf8_slices(batch.column(3)):
            rows += [(len(s), *digest(s)) for s in shingle_sets(data, offsets)]
        columns = [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t1", "t2", "n_shingles", "d1", "d2"])

    rows = docs.select(F.col("doc_id").cast("long"), *text_key(), F.col("text").cast("string"))
    return map_arrow(rows, run, "doc_id long, t1 long, t2 long, n_shingles long, d1 long, d2 long")


# --- blobs: (owner, 64-bit value) pairs dealt to buckets by value --------------------------------

BLOB = "bucket int, kind int, flush long, owners binary, counts binary, vals binary"
#: Kinds of blobs: values that one owner of a map task's flush has, one owner of each value that
#: several have, and what the flush says of those itself (owners and a number for each).
ALONE, SHARED, SAID = 0, 1, 2


class Blobs:
    """Collects (owner, distinct values) and gives packed rows by bucket; 32 bits of each value are kept beside the bucket.

    ``settle(ids, owner, value)`` gets the owners (numbers into ``ids``) of values that several
    owners have, by value, and gives owners and a number for each.
    """

    def __init__(self, buckets: int, most: int, settle):
        self.buckets, self.most, self.settle = buckets, most, settle
        self.task, self.flushes = TaskContext.get().partitionId() << 32, 0
        self.owners, self.values, self.size = [], [], 0

    def add(self, owner: int, values: np.ndarray):
        self.owners.append(owner)
        self.values.append(values)
        self.size += len(values)
        if self.size >= self.most:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        values = np.concatenate(self.values) if self.values else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.owners), dtype=np.int32), [len(v) for v in self.values])
        ids = np.array(self.owners, dtype=np.int64)
        self.owners, self.values, self.size = [], [], 0
        order = np.argsort(values, kind="stable")
        by_value = values[order]
        again = np.zeros(len(values) + 1, dtype=bool)
        again[1:-1] = by_value[1:] == by_value[:-1]
        several = again[:-1] | again[1:]
        out = {"bucket": [], "kind": [], "flush": [], "owners": [], "counts": [], "vals": []}
        name = self.task + self.flushes
        self.flushes += 1
        for kind, chosen in ((ALONE, np.sort(order[~several])), (SHARED, order[several & ~again[:-1]])):
            self._pack(out, kind, name, ids, owner[chosen], values[chosen])
        said, number = self.settle(ids, owner[order[several]], by_value[several])
        for at in range(0, len(said), 1 << 18):
            row = (name + at) % self.buckets, SAID, name, said[at : at + (1 << 18)].tobytes(), b"", number[at : at + (1 << 18)].tobytes()
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], list(out))

    def _pack(self, out: dict, kind: int, name: int, ids: np.ndarray, owner: np.ndarray, values: np.ndarray) -> None:
        bucket = ((values >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        bucket = bucket.astype(np.uint16 if self.buckets <= 1 << 16 else np.int64)
        order = np.lexsort((owner, bucket)) if kind == SHARED else np.argsort(bucket, kind="stable")
        bucket, owner, low = bucket[order], owner[order], (values[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
        cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            if b > a:
                first = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]]))
                out["bucket"].append(int(bucket[a]))
                out["kind"].append(kind)
                out["flush"].append(name)
                out["owners"].append(ids[owner[a:b][first]].tobytes())
                out["counts"].append(np.diff(np.append(first, b - a)).astype("<u4").tobytes())
                out["vals"].append(low[a:b].tobytes())


def _opened(group: pa.Table):
    """A bucket's entries by value: owner, flush, whether several had it, and where each value's entries begin; then what flushes say: owner, flush, number."""
    kind = group.column("kind").to_numpy()
    flush = group.column("flush").to_numpy()
    raw = {c: group.column(c).to_pylist() for c in ("owners", "counts", "vals")}
    joined = lambda column, rows, t: np.frombuffer(b"".join(raw[column][i] for i in rows), t)
    rows = np.flatnonzero(kind != SAID)
    counts = joined("counts", rows, "<u4").astype(np.int64)
    size = np.array([len(raw["vals"][i]) // 4 for i in rows], np.int64)
    value = joined("vals", rows, "<u4")
    order = np.argsort(value, kind="stable")
    value = value[order]
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    entries = np.repeat(joined("owners", rows, np.int64), counts)[order], np.repeat(flush[rows], size)[order], np.repeat(kind[rows] == SHARED, size)[order], start
    rows = np.flatnonzero(kind == SAID)
    said = joined("owners", rows, np.int64)
    return entries, (said, np.repeat(flush[rows], [len(raw["owners"][i]) // 8 for i in rows]), joined("vals", rows, np.int64))


def bucket_number(entries: int) -> int:
    """Buckets that keep their content near a fixed size whatever the input's."""
    return int(max(64, min(1 << 20, entries // PER_BUCKET)))


def blob_entries(buckets: int) -> int:
    """Entries that a map task collects before it sends them to this many buckets."""
    return min(1 << 22, max(LEAST_BLOB, 16 * buckets))


def shared_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """key (half of a set's digest; sets that have it in common may be given more), shared: how many of its shingles another set has too."""
    most = blob_entries(buckets)

    def settle(ids, owner, value):
        n = np.bincount(owner, minlength=len(ids))
        return ids[n > 0], n[n > 0].astype(np.int64)

    def blobs(batches):
        out, seen = Blobs(buckets, most, settle), set()
        for batch in batches:
            for _, data, offsets in utf8_slices(batch.column(0)):
                for s in shingle_sets(data, offsets):
                    if len(s) and (key := digest(s)) not in seen:
                        seen.add(key)
                        for full in out.add(key[0], s):
                            seen.clear()
                            yield full
        if out.owners:
            yield out.flush()

    def count(group: pa.Table) -> pa.Table:
        (owner, flush, several, start), (said, by, number) = _opened(group)
        if len(start):
            size = np.diff(np.append(start, len(owner)))
            shared = (np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)) | np.logical_or.reduceat(several, start)
            counted = np.repeat(shared, size) & ~several
            owner, flush = owner[counted], flush[counted]
        order = np.lexsort((flush, owner))
        owner, flush = owner[order], flush[order]
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (flush[1:] != flush[:-1])])) if len(owner) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(owner)))
        return pa.table({"key": np.append(owner[first], said), "flush": np.append(flush[first], by), "shared": np.append(n, number).astype(np.int64)})

    parts = map_batches(docs.select(F.col("text").cast("string")), blobs, BLOB)
    counts = parts.groupBy("bucket").applyInArrow(count, "key long, flush long, shared long")
    # copies of a set in several flushes are counted in each
    return counts.groupBy("key", "flush").agg(F.sum("shared").alias("shared")).groupBy("key").agg(F.max("shared").alias("shared"))


# --- PartEnum ------------------------------------------------------------------------------------


def band_starts(percent: int = PERCENT, most: int = 1 << 40) -> list[int]:
    """Least sizes of the bands; a set's partners are in its band or a neighbour."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * 100 // percent + 1)
    return out


_STARTS = np.array(band_starts())


def band_bound(j: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of a link between bands j - 1 and j (or within j - 1)."""
    least = int(_STARTS[j + 1]) - 1 + int(_STARTS[j]) - 1
    return (100 - percent) * least // (100 + percent)


def signatures(shingles: np.ndarray) -> np.ndarray:
    """All PartEnum signatures of a set, for both band pairs that it belongs to."""
    band = int(np.searchsorted(_STARTS, len(shingles), side="right")) - 1
    out = []
    prefix = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles + _SEEDS[2]), out=prefix[1:])
    for j in (band, band + 1):
        k = band_bound(j) if j else 0
        if not k:
            continue  # no such pair, or equal sets only, which are one class
        bad = k // 2
        groups = int(SLACK * (bad + 1)) + 1
        # parts are ranges of the hash, so a sorted set falls into parts one after another
        width = (1 << 64) // (groups * PARTS)
        edges = np.arange(1, groups * PARTS, dtype=np.uint64) * np.uint64(width)
        cut = np.concatenate([[0], np.searchsorted(shingles, edges), [len(shingles)]])
        sums = (prefix[cut[1:]] - prefix[cut[:-1]]).reshape(groups, PARTS)
        sizes = np.diff(cut).reshape(groups, PARTS)
        left = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums  # all parts but one
        filled = sizes.sum(axis=1)[:, None] - sizes > 0
        names = np.arange(groups * PARTS, dtype=np.uint64).reshape(groups, PARTS) + np.uint64(j << 40)
        signed = mix(left + mix(names))
        out.append(signed[filled])
        if int(filled.all(axis=1).sum()) <= bad:
            out.append(signed[~filled])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _equal_once(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of two owners and more, equal ones once: a row for each member with the list's name."""
    size = np.diff(np.append(start, len(owner)))
    total = np.add.reduceat(mix(owner.astype(np.uint64) + _SEEDS[3]), start) if len(start) else np.zeros(0, np.uint64)
    several = np.flatnonzero(size > 1)
    chosen = several[np.unique(total[several], return_index=True)[1]]
    each = size[chosen]
    at = np.repeat(start[chosen] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    return owner[at], np.repeat(mix(total[chosen]).view(np.int64), each)


def member_lists(sets: DataFrame, buckets: int) -> DataFrame:
    """list, id: the members of signatures that two sets or more share, equal lists once.

    Members that share a signature within a map task's flush are a list; one of them stands for
    them in the list of all flushes.
    """
    most = blob_entries(buckets)

    def settle(ids, owner, value):
        start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
        return _equal_once(ids[owner], start)

    def blobs(batches):
        out = Blobs(buckets, most, settle)
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from out.add(key, np.unique(signatures(np.frombuffer(raw, np.uint64))))
        if out.owners:
            yield out.flush()

    def lists(group: pa.Table) -> pa.Table:
        (owner, _, _, start), (said, _, name) = _opened(group)
        member, of = _equal_once(owner, start)
        return pa.table({"list": np.append(of, name), "id": np.append(member, said)})

    parts = map_batches(sets.select("id", "feats"), blobs, BLOB)
    return parts.groupBy("bucket").applyInArrow(lists, "list long, id long").distinct()


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common, total (sizes of intersection and union) of each pair, exact."""
    left = sets.select(F.col("id").alias("a"), F.col("feats").alias("fa"))
    right = sets.select(F.col("id").alias("b"), F.col("feats").alias("fb"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "fa", "fb")

    def run(batch):
        common, total = [], []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            common.append(same)
            total.append(len(both) - same)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "common", "total"])

    return map_arrow(rows, run, "a long, b long, common long, total long")


def links(tested: DataFrame) -> DataFrame:
    return tested.filter(100 * F.col("common") >= PERCENT * F.col("total")).select("a", "b")


def set_table(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """id, n, shared and feats of the sets in ``classes(id, d1, d2, shared, doc)``, told by both halves of their digests; their documents are broadcast only if they are few."""
    wanted = classes.select("id", "d1", "d2", "shared", F.col("doc").alias("_doc"))
    few = classes.count() <= MOST_BROADCAST
    chosen = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string")).join(F.broadcast(wanted) if few else wanted, "_doc")

    def run(batch):
        rows = []
        for _, data, offsets in utf8_slices(batch.column(4)):
            rows += [(*digest(s), len(s), s.tobytes()) for s in shingle_sets(data, offsets)]
        x, y, n, feats = zip(*rows, strict=True)
        # a document's rows may hold several texts
        own = pc.and_(pc.equal(batch.column(1), pa.array(x, pa.int64())), pc.equal(batch.column(2), pa.array(y, pa.int64())))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(3), pa.array(feats, pa.binary())], ["id", "n", "shared", "feats"]).filter(own)

    return map_arrow(chosen.select("id", "d1", "d2", "shared", "text"), run, "id long, n long, shared long, feats binary").dropDuplicates(["id"])


def unresolved(lists: DataFrame, found: DataFrame) -> DataFrame:
    """id, c (component) of the sets that share a signature with a set of another component, and some more.

    A signature's lists meet in the list of their representatives: from an unresolved list others
    of its signature are two steps away at most.
    """
    named = written(lists.join(found, "id", "left").select("list", "id", F.coalesce("component", "id").alias("c")), "named")
    open_lists = named.groupBy("list").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("list")
    for _ in range(2):
        touched = named.join(open_lists, "list", "left_semi").select("id").distinct()
        open_lists = named.join(touched, "id", "left_semi").select("list").distinct()
    return named.join(open_lists, "list", "left_semi").select("id", "c").distinct()


def rare_keys(sets: DataFrame) -> DataFrame:
    """token, id, c, n, shared, p, small: the shingles by which links of ``sets(id, c, n, shared, feats)`` are found.

    A set's shingles are ordered by frequency, then value; ``p`` counts from 0. Links of sizes n <= m
    share ceil(75 (n + m) / 175) shingles at least: at least 6 n / 7 of the smaller set and 3 m / 4 of
    the larger. So their first common one is among the first n / 7 of the smaller set (``small``) and
    among the first m / 4 of the larger.
    """

    def run(batch):
        for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            token = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), key)), pa.array(token)], ["id", "token"])

    each = map_arrow(sets.select("id", "feats"), run, "id long, token long")
    often = each.groupBy("token").agg(F.count("*").alias("df"))
    ordered = each.join(often.filter("df > 1"), "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    rows = ordered.join(sets.drop("feats"), "id").withColumn("alone", F.col("n") - F.size("t"))  # shingles that no other set has come first
    rows = rows.select("id", "c", "n", "shared", "alone", F.posexplode("t").alias("i", "x")).withColumn("p", F.col("alone") + F.col("i"))
    rows = rows.filter(4 * F.col("p") <= F.col("n"))
    return rows.select("x.token", "id", "c", "n", "shared", "p", (7 * F.col("p") <= F.col("n")).alias("small"))


def rare_pairs(keys: DataFrame) -> DataFrame:
    """a, b: sets of different components that share a key early enough for a link.

    Of each token's sets, those beside its largest component (minor) face all others; that
    component's sets are never paired with each other.
    """
    keys = written(keys, "keys")
    sizes = keys.groupBy("token", "c").count().groupBy("token").agg(F.count("*").alias("parts"), F.max_by("c", F.struct("count", "c")).alias("major"))
    named = keys.join(sizes.filter("parts > 1").drop("parts"), "token")
    x, y = (named.toDF(*(f"{side}_{c}" for c in named.columns)) for side in "xy")
    c = F.col
    first = F.struct("x_n", "x_id") < F.struct("y_n", "y_id")
    ways = (c("x_c") != c("x_major")) & (c("x_c") != c("y_c")) & ((c("y_c") == c("y_major")) | (c("x_id") < c("y_id")))
    early = F.when(first, c("x_small")).otherwise(c("y_small"))
    reach = (100 + PERCENT) * F.least(c("x_n") - c("x_p"), c("y_n") - c("y_p")) >= PERCENT * (c("x_n") + c("y_n"))
    may = _may_link("x", "y")
    pairs = x.join(y, (c("x_token") == c("y_token")) & ways & early & reach & may).select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"))
    return pairs.distinct()


def link_components(sets: DataFrame) -> DataFrame:
    """id, component of every set of ``sets(id, n, shared, feats)`` that links with another."""
    entries = sets.agg(F.sum("n")).first()[0] or 0  # about two signatures a shingle
    lists = written(member_lists(sets, bucket_number(2 * entries)), "lists")
    hubs = lists.groupBy("list").agg(F.min("id").alias("hub"), F.max("id").alias("far"))
    star = lists.join(hubs, "list").select(F.explode(F.array(F.struct(F.col("hub").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("far").alias("b")))).alias("p"))
    star = star.select("p.*").filter("a <> b").distinct()
    tested = written(compared(_fitting(star, sets.select("id", "n", "shared")), sets), "tested")
    edges = links(tested)
    found = components(edges)
    open_sets = written(unresolved(lists, found), "open")
    cross = rare_pairs(rare_keys(sets.join(open_sets, "id"))).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    more = written(links(compared(cross, sets)), "more")
    forget(lists, open_sets)
    return components(edges.unionAll(more)) if more.limit(1).count() else found


def _may_link(x: str, y: str):
    """What sizes and support allow: links share 75 of 175 parts of the sizes' sum, and the smaller set has 75 % of the larger's size."""
    c = lambda name: F.col(name)
    enough = (100 + PERCENT) * F.least(c(f"{x}_shared"), c(f"{y}_shared")) >= PERCENT * (c(f"{x}_n") + c(f"{y}_n"))
    return enough & (100 * F.least(c(f"{x}_n"), c(f"{y}_n")) >= PERCENT * F.greatest(c(f"{x}_n"), c(f"{y}_n")))


def _fitting(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose sizes and support allow a link."""
    x, y = sizes.toDF("a", "x_n", "x_shared"), sizes.toDF("b", "y_n", "y_shared")
    return pairs.join(x, "a").join(y, "b").filter(_may_link("x", "y")).select("a", "b")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, t1, t2 (digest of the text), n_shingles, component_id and ``stays`` of every row of ``docs(doc_id, text)``.

    ``stays`` is false for rows other than their component's smallest (doc_id, t1, t2); rows without
    an id or with the empty set stay.
    """
    docs = spread(docs)
    meta = written(set_sizes(docs), "sizes")
    own = meta.filter("n_shingles > 0 and doc_id is not null")
    classes = own.groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("first"))
    # the table gives each class a number of its own, so halves of digests that fall together mix no sets
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    entries = meta.agg(F.sum("n_shingles")).first()[0] or 0
    shared = shared_counts(docs, bucket_number(entries)).withColumnRenamed("key", "d1")
    likely = classes.join(shared, "d1").filter(100 * F.col("shared") >= PERCENT * F.col("n_shingles")).select("id", "d1", "d2", "shared", F.col("first.doc_id").alias("doc"))
    likely = written(likely, "likely")
    sets = written(set_table(docs, likely), "sets")
    found = link_components(sets).select("id", "component")
    named = classes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component").select("d1", "d2", "n_shingles", "least")
    out = meta.join(named, ["d1", "d2", "n_shingles"], "left")
    stays = F.col("least").isNull() | F.col("doc_id").isNull() | (F.struct("doc_id", "t1", "t2") == F.col("least"))
    return out.select("doc_id", "t1", "t2", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"), stays.alias("stays"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row of ``docs(doc_id, text)``."""
    return groups(docs).select("doc_id", "n_shingles", "component_id")
