"""Quality classifier: naive Bayes support vectors (n-gram indicators scaled by class log-count ratios, linear hinge loss).

Features are hashed indicators of word unigrams and bigrams and of the same over word shapes (letters,
digits and marks with runs collapsed). The indicators are scaled by naive Bayes log-count ratios,
each document is brought to unit length, and a linear hinge-loss model is fitted by dual coordinate
descent. A logistic curve over margins of rows left out of the fit, corrected for the class balance
of all learning rows, turns margins into scores.

The fit uses a bounded sample: per class the ``PER_CLASS`` rows with the smallest XXH64(doc_id). It
runs in one executor task; the model has a fixed size.

Defined cases: null text is empty; an empty text gets the score of the bias alone; rows without a
label or id are scored but never learned; an id that has both labels teaches nothing, one that
repeats a label teaches once; repeated rows are scored alike; if a class has no learning row every
score is the share of label 1 (0.5 without any); extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markscribe.llm.common import hash_words, map_arrow, map_batches, mix, spread, utf8_slices

BITS = 18
PER_CLASS = 3000
THRESHOLD = 0.7
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[48:58] = 48
_SHAPES[65:91] = 65
_SHAPES[97:123] = 97
_SHAPES[128:] = 97
_SALTS = [np.uint64(x) for x in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B, 0x510E527FADE682D1)]


def _ngrams(words: np.ndarray, bounds: np.ndarray, a: np.uint64, b: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of unigrams and bigrams with their documents' numbers."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    shift = np.uint64(64 - BITS)
    one = mix(words ^ a) >> shift
    pair = mix(words[:-1] * np.uint64(3) + words[1:] + b) >> shift
    same = doc[:-1] == doc[1:]
    return np.concatenate([one, pair[same]]), np.concatenate([doc, doc[:-1][same]])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each document, one after another, and where each document's begin."""
    shapes = _SHAPES[data]
    keep = np.ones(len(shapes), dtype=bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    cut = offsets[:-1]
    keep[cut[cut < len(keep)]] = True
    moved = np.concatenate([[0], np.cumsum(keep)])[offsets]
    b1, d1 = _ngrams(*hash_words(data, offsets, lower=False), _SALTS[0], _SALTS[1])
    b2, d2 = _ngrams(*hash_words(shapes[keep], moved, lower=False), _SALTS[2], _SALTS[3])
    keys = np.unique((np.concatenate([d1, d2]).astype(np.uint64) << np.uint64(BITS)) | np.concatenate([b1, b2]))
    doc = (keys >> np.uint64(BITS)).astype(np.int64)
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int32), np.searchsorted(doc, np.arange(len(offsets)))


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        # each document's terms are added one after another, so that equal texts have equal scores wherever they stand
        n = len(bounds) - 1
        document = np.repeat(np.arange(n), np.diff(bounds))
        total = lambda v: np.bincount(document, weights=v, minlength=n)
        r = self.ratio[found]
        norm = np.sqrt(np.maximum(total(r * r), 1e-12))
        return total(r * self.weight[found]) / norm + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -35, 35)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    count = {k: np.full(1 << BITS, smooth) for k in (1, 0)}
    for x, label in zip(rows, y, strict=True):
        count[int(label)][x] += 1
    return (np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM; rows have unit length, the bias is one more feature."""
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    sign, rng = np.where(y > 0, 1.0, -1.0), np.random.Generator(np.random.PCG64(seed))
    square = np.array([float(v @ v) + 1 for v in values])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = sign[i] * (float(w[x] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve (Newton steps with smoothed targets)."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target, p = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)), np.zeros(2)
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -35, 35)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (q - target) + 1e-3 * p)
        p = p - np.clip(step, -5, 5)
    return float(p[0]), float(p[1])


def fit_rows(rows: list[np.ndarray], y: np.ndarray, share: float) -> Model:
    """Fit on three quarters of the rows; the rest sets the curve. ``share``: of label 1 among all learning rows."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    if not len(y) or y.min() == y.max():
        zero = np.zeros(1 << BITS, np.float32)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    rest = np.arange(len(y)) % 4 == 3
    if len(set(y[rest])) < 2 or len(set(y[~rest])) < 2:
        rest[:] = False
    fit = [i for i in range(len(y)) if not rest[i]]
    ratio = log_count_ratios([rows[i] for i in fit], y[fit])
    scaled = lambda x: (v := ratio[x].astype(np.float64)) / max(1e-6, float(np.sqrt(v @ v)))
    w, bias = dual_coordinate_descent([rows[i] for i in fit], [scaled(rows[i]) for i in fit], y[fit])
    own = np.flatnonzero(rest) if rest.any() else np.arange(len(y))
    margins = np.array([float(w[rows[i]] @ scaled(rows[i])) + bias for i in own])
    slope, shift = _logistic(margins, y[own].astype(float))
    odds = lambda p: np.log(p / (1 - p))
    shift += float(odds(share) - odds(float(np.clip(y.mean(), 1e-6, 1 - 1e-6))))
    return Model(ratio, w.astype(np.float32), float(bias), slope, shift)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Fit on ``docs(doc_id, text)`` whose id has a label 0 or 1 in ``labels``; the sample is bounded by ``per_class``.

    Of rows that share a sampled id the one with the smallest text teaches.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").select("id", "y")
    balance = dict(known.groupBy("y").count().collect())
    share = balance.get(1, 0) / sum(balance.values()) if balance else 0.5
    sample = None
    for y in (0, 1):
        own = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        sample = own if sample is None else sample.unionAll(own)
    joined = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    joined = joined.groupBy("id", "y").agg(F.min("text").alias("text"))  # rows that repeat an id teach once: the sample is bounded in rows

    def train(batches):
        rows, y, order = [], [], []
        for batch in batches:
            for first, data, offsets in utf8_slices(batch.column(1)):
                found, bounds = features(data, offsets)
                rows += [found[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            y += batch.column(2).to_pylist()
            order += batch.column(0).to_pylist()
        by_hash = np.argsort(mix(np.array(order, dtype=np.int64).astype(np.uint64)), kind="stable")
        m = fit_rows([rows[i] for i in by_hash], np.array(y, dtype=np.int64)[by_hash], share)
        yield pa.RecordBatch.from_pydict({"ratio": [m.ratio.tobytes()], "weight": [m.weight.tobytes()], "rest": [[m.bias, m.slope, m.shift]]})

    got = map_batches(joined.select("id", "text", "y").repartition(1), train, "ratio binary, weight binary, rest array<double>").collect()
    if not got:
        return fit_rows([], np.zeros(0), share)
    return Model(np.frombuffer(bytes(got[0][0]), np.float32), np.frombuffer(bytes(got[0][1]), np.float32), *got[0][2])


def learning_rows(labels: DataFrame) -> DataFrame:
    """Labels that may be learned: crc32(doc_id as text) mod 4 is not 2."""
    return labels.filter(F.col("doc_id").isNotNull() & ~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (a name that no column of ``docs`` may have), the text read whole."""
    at = docs.columns.index(text)

    def run(batch):
        score = np.zeros(batch.num_rows)
        for first, data, offsets in utf8_slices(batch.column(at)):
            score[first : first + len(offsets) - 1] = model.scores(model.margins(*features(data, offsets)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    return map_arrow(spread(docs), run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
