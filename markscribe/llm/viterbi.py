"""SentencePiece encoding by streaming Viterbi, and decoding.

The piece scores of a public vocabulary are read as unigram log scores. The encoder goes from boundary
to boundary and keeps scores only for the window that the next pieces can reach (the longest piece),
and back pointers since the last commit. Every path carries its root, its last boundary up to a mark;
whenever the paths to all boundaries ahead have one root, the ids before it are committed and
forgotten, so memory does not grow with the text. Where no piece of the vocabulary can cross a
position (before a word mark that follows another character, around a line end that no piece holds)
all paths meet by construction, so the ids before it are committed and the text falls into segments
there; long ones also where a block's pieces show it. All distinct segments of a slice that have one length stream together, as rows of arrays; few
of a length stream one by one. Pieces are looked up in a trie, whole blocks at once; scores are sums
from a segment's beginning, so neither way of streaming nor the commits change a comparison.

Ties go to the piece that begins first. Characters outside the vocabulary become byte pieces.
Defined cases: null or empty text has no ids; a text that holds U+2581 itself decodes to a space
there, as in the public format, and ``round_trip`` is false.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import Table, code_points, distinct_strings, gather, map_batches, spread, tokenizer_path, utf8_slices

MARK = "▁"
#: Bytes of text that are encoded together.
SLICE = 1 << 21
#: Boundaries whose pieces are looked up together, and boundaries between two looks for a meeting of paths.
BLOCK, STRIDE = 1024, 16
#: Code points that a long segment is fed by, and rows of one length that are worth arrays.
FED, LEAST_ROWS = 4096, 12
#: No code point of any piece, and no id.
END, NONE = (1 << 21) - 1, np.iinfo(np.int64).min
SCHEMA = "doc_id long, n_ids long, ids_crc32 long, decoded_chars long, round_trip boolean"


class PieceModel:
    """Pieces, scores and byte pieces of a vocabulary file."""

    def __init__(self, name: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.surface: list[bytes] = []
        self.bytes: dict[int, int] = {}
        self.unknown = sp.unk_id()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.scores.append(sp.get_score(i))
            self.surface.append(piece.replace(MARK, " ").encode())
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif sp.is_control(i) or sp.is_unknown(i):
                self.surface[i] = b""
            else:
                self.ids[piece] = i
        self.longest = max(map(len, self.ids))
        self.unknown_score = min(self.scores[i] for i in self.ids.values()) - 10
        self.segmented = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.lines_apart = not any("\n" in p for p in self.ids)
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_sizes = np.array([len(x) for x in self.surface])
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.score = np.array(self.scores)
        children: dict[tuple[int, str], int] = {}
        ends = {}
        for piece, i in self.ids.items():
            node = 0
            for char in piece:
                node = children.setdefault((node, char), len(children) + 1)
            ends[node] = i
        self.children = Table(np.array([n << 21 | ord(c) for n, c in children], np.int64), np.array([*children.values()], np.int32))
        self.piece = np.full(len(children) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())


def matches(model: PieceModel, points: np.ndarray, n: int) -> list[np.ndarray]:
    """By size - 1: ids of the pieces of that size from each of the first ``n`` columns of rows of code points (-1: none), as far as any piece goes; rows end in ``longest`` columns of END."""
    found, node = [], np.zeros((len(points), n), np.int64)
    for depth in range(model.longest):
        alive = node >= 0
        after = np.full(node.shape, -1, np.int64)
        after[alive] = model.children.get(node[alive] << 21 | points[:, depth : depth + n][alive])
        node = after
        if depth and not (node >= 0).any():
            break
        found.append(np.where(node >= 0, model.piece[node], -1))
    return found


class StreamingViterbi:
    """One text: feed it piece by piece; ids come out as soon as they are certain.

    ``best``, ``width``, ``ids`` and ``root`` begin at ``base``, the last boundary whose ids are out, and
    reach as far as the pieces from ``at``, the boundary taken up next. A root is the last boundary of a
    path that is not beyond the mark where roots were last set.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.points = np.zeros(0, np.int64)
        self.at = self.base = 0
        self.best, self.width, self.ids, self.root = [0.0], [0], [0], [0]
        self.widest = 0

    def feed(self, text: str):
        yield from self.take(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64))

    def take(self, points: np.ndarray):
        self.points = np.concatenate([self.points, points])
        yield from self._run(len(self.points) - self.model.longest)

    def finish(self):
        yield from self._run(len(self.points))
        yield from self._commit(self.at)

    def _run(self, n: int):
        """Take up the next ``n`` boundaries, whose pieces are known to their ends."""
        m, done = self.model, 0
        while done < n:
            size = min(BLOCK, n - done)
            own = self.points[done : done + size + m.longest]
            found = np.stack([f[0] for f in matches(m, np.concatenate([own, np.full(m.longest, END)])[None], size)])
            start, depth = np.nonzero(found.T >= 0)
            i = found[depth, start]
            pieces = [*zip((depth + 1).tolist(), i.tolist(), m.score[i].tolist(), strict=True)]
            bounds = np.searchsorted(start, np.arange(size + 1)).tolist()
            for k, alone in enumerate((found[0] < 0).tolist()):
                at = self.at - self.base
                some = pieces[bounds[k] : bounds[k + 1]]
                more = at + (some[-1][0] if some else 1) + 1 - len(self.best)
                if more > 0:
                    self.best += [-np.inf] * more
                    self.width += [0] * more
                    self.ids += [0] * more
                    self.root += [0] * more
                if alone:
                    some.append((1, -1 - int(own[k]), m.unknown_score))
                best, score, root = self.best, self.best[at], self.root[at]
                for w, i, plus in some:
                    to = at + w
                    if score + plus > best[to]:
                        best[to], self.width[to], self.ids[to], self.root[to] = score + plus, w, i, root
                self.at += 1
                if self.at % STRIDE == 0:
                    self.widest = max(self.widest, len(self.best))
                    yield from self._meet()
            done += size
        self.points = self.points[max(done, 0) :]

    def _meet(self):
        """Commit if the paths to all boundaries ahead have one root."""
        live = [e for e in range(self.at - self.base, len(self.best)) if self.best[e] > -np.inf]
        root = self.root[live[0]]
        if all(self.root[e] == root for e in live):
            for e in live:
                self.root[e] = self.base + e - self.width[e]
            yield from self._commit(root)

    def _commit(self, upto: int):
        out, at = [], upto - self.base
        while at > 0:
            i = self.ids[at]
            out.append([i] if i >= 0 else [self.model.bytes[b] for b in chr(-1 - i).encode()])
            at -= self.width[at]
        gone = upto - self.base
        self.best, self.width, self.ids, self.root, self.base = self.best[gone:], self.width[gone:], self.ids[gone:], self.root[gone:], upto
        for group in reversed(out):
            yield from group


class StreamingRows:
    """The same for rows of one length, all at once: scores in a ring as wide as the longest piece, back pointers since the last boundary that is common to all paths of each row."""

    def __init__(self, model: PieceModel, points: np.ndarray):
        self.model, (self.n, self.length) = model, points.shape
        self.points = np.concatenate([points, np.full((self.n, model.longest), END)], axis=1)
        self.size = min(self.length, model.longest) + 1
        self.best = np.full((self.size, self.n), -np.inf)
        self.best[0] = 0
        self.width, self.ids, self.root = (np.zeros((self.size, self.n), np.int64) for _ in range(3))
        self.base, self.first = np.zeros(self.n, np.int64), 0
        self.widths, self.kept = (np.zeros((min(self.length + 1, 4 * model.longest), self.n), np.int64) for _ in range(2))
        self.out = np.full((self.n, self.length), NONE)
        self.widest = len(self.kept)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best paths, one row after another (a character outside the vocabulary: -1 - its code point), and how many each row has."""
        m = self.model
        streams = self.length > m.longest  # shorter rows never leave the window
        for at in range(self.length):
            k = at % BLOCK
            if k == 0:
                found = matches(m, self.points[:, at : at + BLOCK + m.longest], min(BLOCK, self.length - at))
                some = [f.any(axis=0).tolist() for f in (f >= 0 for f in found)]
                alone = (found[0] < 0).any(axis=0).tolist()
            own = at % self.size
            for depth, f in enumerate(found):
                if some[depth][k]:
                    i = f[:, k]
                    self._push(own, (at + depth + 1) % self.size, depth + 1, i, i >= 0, m.score[i], streams)
            if alone[k]:
                self._push(own, (at + 1) % self.size, 1, -1 - self.points[:, at], found[0][:, k] < 0, m.unknown_score, streams)
            self.best[own] = -np.inf
            if streams and at % STRIDE == STRIDE - 1:
                self._meet(at)
            self._keep(at + 1)
        self._commit(np.arange(self.n), np.full(self.n, self.length))
        placed = self.out != NONE
        return self.out[placed], placed.sum(axis=1)

    def _push(self, own: int, to: int, width: int, ids: np.ndarray, there: np.ndarray, plus, streams: bool) -> None:
        score = self.best[own] + plus
        take = there & (score > self.best[to])
        np.copyto(self.best[to], score, where=take)
        np.copyto(self.width[to], width, where=take)
        np.copyto(self.ids[to], ids, where=take)
        if streams:
            np.copyto(self.root[to], self.root[own], where=take)

    def _keep(self, at: int) -> None:
        """Write down how the best path reaches a boundary that no later piece can change."""
        if at - self.first == len(self.kept):
            low = int(self.base.min())
            if low > self.first:
                for a in (self.widths, self.kept):
                    a[: self.first - low] = a[low - self.first :].copy()
                self.first = low
            else:
                self.widths, self.kept = (np.concatenate([a, np.zeros_like(a)]) for a in (self.widths, self.kept))
                self.widest = len(self.kept)
        self.widths[at - self.first], self.kept[at - self.first] = self.width[at % self.size], self.ids[at % self.size]

    def _meet(self, at: int) -> None:
        """Commit the rows in which the paths to all boundaries ahead of ``at`` have one root."""
        root = self.root[(at + 1) % self.size].copy()
        same = np.flatnonzero(((self.root == root) | (self.best == -np.inf)).all(axis=0))
        ahead = at + 1 + (np.arange(self.size) - at - 1) % self.size
        self.root[:, same] = ahead[:, None] - self.width[:, same]
        on = same[root[same] > self.base[same]]
        self._commit(on, root[on])
        self.base[on] = root[on]

    def _commit(self, rows: np.ndarray, end: np.ndarray) -> None:
        while len(rows):
            self.out[rows, end - 1] = self.kept[end - self.first, rows]
            end = end - self.widths[end - self.first, rows]
            going = end > self.base[rows]
            rows, end = rows[going], end[going]


class Codec:
    """Encode whole texts to ids and decode ids to texts."""

    def __init__(self, name: str):
        self.model = PieceModel(name)

    def stream(self, marked: str) -> list[int]:
        """Ids of a text with its marks, through the window."""
        v = StreamingViterbi(self.model)
        return [*v.feed(marked), *v.finish()]

    def _streamed(self, points: np.ndarray) -> list[int]:
        v = StreamingViterbi(self.model)
        return [*(i for k in range(0, len(points), FED) for i in v.take(points[k : k + FED])), *v.finish()]

    def _uncrossed(self, points: np.ndarray) -> np.ndarray:
        """Positions of a long segment that no piece crosses (0 among them): all paths meet there."""
        m, found = self.model, []
        farthest = 0
        for k in range(0, len(points), BLOCK):
            size = min(BLOCK, len(points) - k)
            padded = np.concatenate([points[k : k + size + m.longest], np.full(m.longest, END)])[None]
            reach = np.zeros(size, np.int64)
            for depth, ids in enumerate(matches(m, padded, size)):
                reach[ids[0] >= 0] = depth + 1
            ends = np.maximum.accumulate(np.concatenate([[farthest], k + np.arange(size) + reach]))
            found.append(k + np.flatnonzero(ends[:-1] <= k + np.arange(size)))
            farthest = int(ends[-1])
        return np.concatenate(found)

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct segments, and where each segment's begin and how many they are."""
        points, at = code_points(data, offsets)
        points[points == 32] = ord(MARK)
        long = np.flatnonzero(np.diff(at) > 2 * self.model.longest)
        if not len(long):
            return self._solved(points, at)
        cuts = np.unique(np.concatenate([at, *(at[i] + self._uncrossed(points[at[i] : at[i + 1]]) for i in long)]))
        ids, starts, sizes = self._solved(points, cuts)
        of = np.searchsorted(at, cuts[:-1], "right") - 1
        joined, bounds = gather(ids, starts, sizes, np.arange(len(cuts) - 1))
        total = np.bincount(of, sizes, len(at) - 1).astype(np.int64)
        return joined, bounds[np.searchsorted(cuts, at[:-1])], total

    def _solved(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = np.diff(at)
        starts, sizes, parts, total = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), [], 0
        for k in np.unique(length).tolist():
            own = np.flatnonzero(length == k)
            for rows in np.array_split(own, 1 + len(own) * k // (1 << 18)):
                if len(rows) >= LEAST_ROWS:
                    ids, n = self._with_bytes(*StreamingRows(self.model, points[at[rows, None] + np.arange(k)]).run())
                else:
                    each = [self._streamed(points[at[i] : at[i + 1]]) for i in rows]
                    ids, n = np.array([i for x in each for i in x], np.int64), np.array([len(x) for x in each], np.int64)
                sizes[rows] = n
                starts[rows] = total + np.cumsum(n) - n
                total += len(ids)
                parts.append(ids.astype("<u4"))
        return np.concatenate([*parts, np.zeros(0, "<u4")]), starts, sizes

    def _with_bytes(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the pieces of their bytes."""
        odd = ids < 0
        if not odd.any():
            return ids, n
        chars, codes = np.unique(-1 - ids[odd], return_inverse=True)
        each = [[self.model.bytes[b] for b in chr(c).encode()] for c in chars.tolist()]
        sizes = np.array([len(x) for x in each])
        repeats = np.ones(len(ids), np.int64)
        repeats[odd] = sizes[codes]
        out = np.repeat(ids, repeats)
        out[np.repeat(odd, repeats)] = gather(np.concatenate([np.array(x) for x in each]), np.cumsum(sizes) - sizes, sizes, codes)[0]
        total = np.concatenate([[0], np.cumsum(repeats)])
        ends = np.cumsum(n)
        return out, total[ends] - total[ends - n]

    def encode(self, column: pa.Array):
        """Yield (first row, ids one after another, where each row's begin): texts get a leading mark, and marks for spaces."""
        column = pc.fill_null(column, "")
        if pc.any(pc.match_substring(column, MARK)).as_py():
            column = pc.replace_substring(column, MARK, " ")
        empty = pc.equal(pc.binary_length(column), 0)
        for first, data, offsets in utf8_slices(pc.if_else(empty, "", pc.binary_join_element_wise("", column, " ")), SLICE):
            start = np.zeros(len(data) + 1, dtype=bool)
            if self.model.segmented:
                start[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
                if self.model.lines_apart:
                    line = data == 10
                    start[:-1] |= line
                    start[1:] |= line
            start[offsets] = True
            at = np.flatnonzero(start)
            codes, segments, own = distinct_strings(data, at)
            ids, bounds = gather(*self._segments(segments, own), codes)
            yield first, ids, bounds[np.searchsorted(at, offsets)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of the texts one after another, and where each one's begin; a text's leading mark goes."""
        data, of = gather(self.model.surfaces, self.model.surface_starts, self.model.surface_sizes, ids.astype(np.int64))
        starts = of[bounds]
        marked = np.zeros(len(bounds) - 1, dtype=bool)
        some = starts[1:] > starts[:-1]
        marked[some] = data[starts[:-1][some]] == 32
        keep = np.ones(len(data), dtype=bool)
        keep[starts[:-1][marked]] = False
        return data[keep], starts - np.concatenate([[0], np.cumsum(marked)])


def _texts(docs: DataFrame) -> DataFrame:
    return spread(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Each document's key and ``ids`` array<int>."""

    def run(batches):
        codec = Codec(model)
        for batch in batches:
            for first, ids, bounds in codec.encode(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(lists)), lists], ["doc_id", "ids"])

    return map_batches(_texts(docs), run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """The texts of ``encode_documents``' rows; bytes that are no UTF-8 are replaced, null ids give an empty text."""

    def run(batches):
        codec = Codec(model)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), pa.scalar([], batch.column(1).type))
            data, at = codec.decode(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64))
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def encoded_digest(docs: DataFrame, model: str) -> DataFrame:
    """Per document: number and CRC-32 of its ids, code points decoded, and whether decoding gives the text back."""
    kinds = [pa.int64()] * 4 + [pa.bool_()]

    def run(batches):
        codec = Codec(model)
        for batch in batches:
            for first, ids, bounds in codec.encode(batch.column(1)):
                data, at = codec.decode(ids, bounds)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
                own = batch.column(1).slice(first, len(bounds) - 1)
                rows, decoded = [], memoryview(data)
                for i, (key, text) in enumerate(zip(batch.column(0).slice(first, len(own)).to_pylist(), own, strict=True)):
                    raw = memoryview(text.as_buffer() if text.is_valid else b"").cast("B")
                    rows.append((key, bounds[i + 1] - bounds[i], zlib.crc32(ids[bounds[i] : bounds[i + 1]]), chars[i + 1] - chars[i], decoded[at[i] : at[i + 1]] == raw))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

    return map_batches(_texts(docs), run, SCHEMA)
