"""Shared helpers of the training-data operators: tables, scratch space, vectorised word hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the contracts: x20 and x09-x0D.
SPACE_CODES = (9, 10, 11, 12, 13, 32)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A tokenizer's file: a path stays, a bare name is looked up on the machine that opens it."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt anew if it has fewer partitions than the cluster has cores (it is small then)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.groupBy(F.spark_partition_id().alias("part")).count().count() >= cores else df.repartition(cores)


#: Our own folder, where the setting is unset.
_OWN_DIR: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where unset, our own on a single machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        if not _OWN_DIR:
            _OWN_DIR.append(tempfile.mkdtemp(prefix="markscribe-"))
            atexit.register(shutil.rmtree, _OWN_DIR[0], True)
        found = _OWN_DIR[0]
    return found.rstrip("/")


_SCOPE: ContextVar[list | None] = ContextVar("scratch", default=None)
_LEFT: list[DataFrame] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut, lost executors cost nothing.

    The table is deleted by ``forget``, at the end of the innermost ``scratch``, or when the driver
    exits, as lazy results may read it until then.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/markscribe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    own = _SCOPE.get()
    (_LEFT if own is None else own).append(back)
    return back


def forget(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for t in tables:
        delete(t.sparkSession, t.scratch_path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch():
    """Tables written inside are deleted at its end; what is returned from it must not read them lazily."""
    own: list[DataFrame] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        forget(*own)


@atexit.register
def _forget_left() -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        forget(*_LEFT)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` that gives memory back when a task ends."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` of a function that takes a RecordBatch and yields RecordBatches."""
    return map_batches(df, lambda batches: (out for batch in batches for out in function(batch)), schema)


def release() -> None:
    """Give freed memory back to the system at a task's end: executors keep their idle Python workers."""
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


# --- arrays of strings -------------------------------------------------------------------------


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[starts[c] : starts[c] + sizes[c]]`` of all codes one after another, and where each one's begins."""
    each = sizes[codes]
    bounds = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(each, out=bounds[1:])
    return values[np.repeat(starts[codes] - bounds[:-1], each) + np.arange(bounds[-1])], bounds


def distinct_strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the strings ``data[offsets[i] : offsets[i + 1]]``, and UTF-8 and offsets of the distinct strings that codes stand for."""
    buffers = pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    found = pa.StringArray.from_buffers(len(offsets) - 1, *buffers).dictionary_encode()
    _, at, raw = found.dictionary.buffers()
    n = len(found.dictionary)
    at = np.frombuffer(at, np.int32)[: n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    return found.indices.to_numpy(), np.frombuffer(raw, np.uint8)[: at[-1]] if raw is not None else np.zeros(0, np.uint8), at


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the offsets in them."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    first = data[at].astype(np.int64)
    out = first.copy()
    for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        some = np.flatnonzero((first >= least) & (first < (0xE0, 0xF0, 0x100)[more - 1]))
        value = first[some] & mask
        for k in range(1, more + 1):
            value = (value << 6) | (data[at[some] + k] & 0x3F)
        out[some] = value
    return out, np.concatenate([[0], np.cumsum(lead)])[offsets]


class Table:
    """Exact lookup of whole arrays of keys (integers of 63 bits) by open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            free = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Each key's value, -1 where there is none."""
        slot = self._slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there != -1)]
        return out


# --- vectorised word hashing -------------------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_CODES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_slices(column: pa.Array, most: int = 1 << 19):
    """Yield (first row, UTF-8 bytes, offsets) over runs of rows of at most ``most`` bytes (one row at least)."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of word bytes begin and end; runs never cross documents."""
    n = len(word)
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    cut = offsets[:-1]
    before[cut[cut < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    cut = offsets[1:]
    after[cut[cut > 0] - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` and, per document, where its words begin and end.

    Words never cross documents. A word's hash is a polynomial over its bytes taken from prefix sums
    modulo 2**64, then finalised together with the length.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data] if lower else data
    starts, ends = word_spans(~_IS_SPACE[low], offsets)
    up, down = _powers(n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[low] * up[:n], out=prefix[1:])
    hashes = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(starts, offsets)
