"""Cost-balanced packing of tokenised documents into sequences of bounded length.

Documents are packed chunk by chunk inside each input partition (no shuffle): a chunk holds about
``chunk_tokens`` ids, so memory is bounded and a lost executor repeats its partition only. A piece
of n ids costs ``linear * n + quadratic * n * n`` (attention stays within a piece). Pieces go in
descending cost to the lowest-cost sequence that still has room for them; a piece that fits nowhere
is cut. A chunk of T ids gets T // capacity full sequences, and the rest is taken by sequences whose
lengths are the powers of two of T % capacity, which need no padding.

Defined cases: null or empty text packs its end id alone; repeated rows are packed each; an empty
table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import Table, code_points, distinct_strings, gather, map_batches, spread, tokenizer_path, utf8_slices, word_spans

CAPACITY = 4096
#: Bytes of text that are tokenised together.
SLICE = 1 << 21
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, padded_length long"
#: Longest word (bytes) that is merged by arrays.
_LONGEST = 64
_NO_RANK = np.int32(2**31 - 1)
_SPACE, _DIGIT = 0, 2
_LATIN = [chr(i) for i in range(0x180)]
_KINDS = np.array([0 if c in "\t\n\x0b\x0c\r \x85\xa0" else 1 if unicodedata.category(c)[0] == "L" else 2 if unicodedata.category(c)[0] == "N" else 3 for c in _LATIN], np.uint8)
_SMALL = np.array([ord(c.lower()[0]) for c in _LATIN])
#: The characters that stand for the bytes in byte-level vocabularies: printable ones themselves, the others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = [chr(b) if b in _PRINTED else chr(0x100 + b - sum(p < b for p in _PRINTED)) for b in range(256)]


class WordTokenizer:
    """Ids of whole texts. The distinct words of a slice of texts are tokenised together, by whole arrays.

    The vocabulary drops white space and never lets a token cross a space or a line end, so a
    text's ids are its words' ids in order. Words of Latin letters, digits and marks fall into runs
    (letters, single digits, other marks); the runs' bytes are merged pair by pair, lowest rank and
    leftmost first, all runs at once. Other words, and those with an apostrophe or ``<`` (which may
    begin contractions and special tokens), go to the tokenizer itself.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.first = np.array([ids[c] for c in _BYTE_CHARS], np.int32)
        self.last = np.array([ids[c + end] for c in _BYTE_CHARS], np.int32)
        self.ranks = Table(np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64), np.arange(len(pairs)))
        self.product = np.array([ids[a + b] for a, b in pairs], np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts in UTF-8 one after another, and where each text's begin."""
        word = (data != 32) & (data != 10)
        starts, ends = word_spans(word, offsets)
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=at[1:])
        codes, words, at = distinct_strings(data[word], at)
        ids, bounds = gather(*self._words(words, at), codes)
        return ids, bounds[np.searchsorted(starts, offsets)]

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each word's begin and how many they are."""
        odd = (data > 0xC5) | (data == 0x27) | (data == 0x3C)  # U+0180 and beyond, ' and <
        odd[:-1] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)  # U+0130, whose small form is two characters
        size = np.diff(offsets)
        odd = (np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) > 0) | (size > _LONGEST)
        others = [np.array(e, np.int32) for e in self._tokenized([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in np.flatnonzero(odd)])]
        plain, bounds = self._runs(data[np.repeat(~odd, size)], np.concatenate([[0], np.cumsum(size[~odd])]))
        starts, sizes = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        starts[~odd], sizes[~odd] = bounds[:-1], np.diff(bounds)
        sizes[odd] = [len(x) for x in others]
        starts[odd] = len(plain) + np.cumsum(sizes[odd]) - sizes[odd]
        return np.concatenate([plain, *others]), starts, sizes

    def _tokenized(self, words: list[str]):
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for at in range(0, len(words), 1024):
            yield from (e.ids for e in batch(words[at : at + 1024], add_special_tokens=False))

    def _runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of code points below U+0180 one after another, and where each word's begin."""
        points, words = code_points(data, offsets)
        kind, points = _KINDS[points], _SMALL[points]
        start = np.ones(len(kind), dtype=bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start[words[words < len(kind)]] = True
        kept = kind != _SPACE
        words = np.concatenate([[0], np.cumsum(kept)])[words]
        points, starts = points[kept], np.flatnonzero(start[kept])
        two = points >= 0x80
        place = np.concatenate([[0], np.cumsum(1 + two)])
        raw = np.empty(place[-1], np.uint8)
        raw[place[:-1]] = np.where(two, 0xC0 | points >> 6, points)
        raw[place[:-1][two] + 1] = 0x80 | points[two] & 0x3F
        codes, raw, at = distinct_strings(raw, np.append(place[starts], place[-1]))
        ids, bounds = gather(*self._merged(raw, at), codes)
        return ids, bounds[np.searchsorted(starts, words)]

    def _merged(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of runs of bytes, and where each run's begin and how many they are."""
        size, least = np.diff(offsets), 0
        starts, sizes, parts, total = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), [], 0
        for most in (4, 8, 12, 16, 32, 2 * _LONGEST):
            rows = np.flatnonzero((size > least) & (size <= most))
            least = most
            if not len(rows):
                continue
            column, n = np.arange(most), size[rows]
            symbols = self.first[data[np.minimum(offsets[rows, None] + column, len(data) - 1)]]
            symbols[column >= n[:, None]] = -1
            symbols[np.arange(len(rows)), n - 1] = self.last[data[offsets[rows] + n - 1]]
            symbols = self._merge(symbols)
            filled = symbols >= 0
            sizes[rows] = filled.sum(axis=1)
            starts[rows] = total + np.cumsum(sizes[rows]) - sizes[rows]
            parts.append(symbols[filled])
            total += len(parts[-1])
        return np.concatenate([*parts, np.zeros(0, np.int32)]), starts, sizes

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.ranks.get(np.maximum(a, 0).astype(np.int64) << 20 | np.maximum(b, 0))
        return np.where((found < 0) | (a < 0) | (b < 0), _NO_RANK, found)

    def _merge(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols (-1 behind the last), merged until no pair has a rank."""
        rows, live = np.arange(len(symbols)), symbols
        rank = self._rank(live[:, :-1].ravel(), live[:, 1:].ravel()).reshape(len(live), -1)
        column = np.arange(symbols.shape[1])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            go = best < _NO_RANK
            if not go.all():
                symbols[rows[~go]] = live[~go]
                rows, live, rank, at, best = (x[go] for x in (rows, live, rank, at, best))
            n = np.arange(len(rows))
            live[n, at] = self.product[best]
            later = column > at[:, None]
            following = np.full_like(live, -1)
            following[:, :-1] = live[:, 1:]
            live = np.where(later, following, live)
            following = np.full_like(rank, _NO_RANK)
            following[:, :-1] = rank[:, 1:]
            rank = np.where(later[:, :-1], following, rank)
            right = np.where(at + 1 < len(column), live[n, np.minimum(at + 1, len(column) - 1)], -1)
            inside = at < rank.shape[1]
            rank[n[inside], at[inside]] = self._rank(live[n, at], right)[inside]
            left = at > 0
            rank[n[left], at[left] - 1] = self._rank(live[n[left], at[left] - 1], live[n[left], at[left]])
        return symbols


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1 / 2048) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) and the length of every sequence."""
    total = sum(lengths)
    rest = total % capacity
    room = [capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    left, cost, used = np.array(room, dtype=np.int64), np.zeros(len(room)), [0] * len(room)
    queue = []
    for doc, n in enumerate(lengths):
        queue += [(-min(capacity, n - s), doc, s) for s in range(0, n, capacity)]
    heapq.heapify(queue)
    pieces = []
    while queue:
        size, doc, start = heapq.heappop(queue)
        n = -size
        fits = left >= n
        k = int(np.argmin(np.where(fits, cost, np.inf)))
        if not fits[k]:
            k = int(np.argmax(left))
            heapq.heappush(queue, (int(left[k]) - n, doc, start + int(left[k])))
            n = int(left[k])
        pieces.append((doc, start, n, k, used[k]))
        used[k] += n
        left[k] -= n
        cost[k] += linear * n + quadratic * n * n
    return pieces, used


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, chunk_tokens: int = 1 << 21, linear: float = 1.0, quadratic: float = 1 / 2048) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; ``start`` counts the document's ids before the piece. ``tokenizer``: a path or a public tokenizer's name."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        words, base = WordTokenizer(tokenizer), TaskContext.get().partitionId() << 32
        ids, keys, size = [], [], 0

        def flush():
            nonlocal base, ids, keys, size
            pieces, used = pack([len(x) for x in ids], capacity, linear, quadratic)
            rows = []
            for doc, start, n, k, offset in pieces:
                padded = used[k] if used[k] & (used[k] - 1) == 0 else capacity
                rows.append((keys[doc], start, n, zlib.crc32(ids[doc][start : start + n]), len(ids[doc]), base + k, offset, used[k], padded))
            base += len(used)
            ids, keys, size = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        for batch in batches:
            for first, data, offsets in utf8_slices(batch.column(1), SLICE):
                found, bounds = words.encode(data, offsets)
                found = np.insert(found, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                for i, key in enumerate(batch.column(0).slice(first, len(offsets) - 1).to_pylist()):
                    ids.append(found[bounds[i] : bounds[i + 1]])
                    keys.append(key)
                    size += len(ids[-1])
                    if size >= chunk_tokens:
                        yield flush()
        if ids:
            yield flush()

    return map_batches(spread(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)
