"""Approximate nearest neighbours by cross-polytope hashing with exact reranking.

Unit vectors go through fast pseudo-rotations (three rounds of random signs and a Hadamard
transform); a table's hash is the signed axis nearest to the rotated vector, for large inputs joined
by the nearest signed axes of further rotations cut to fewer dimensions, so that the mean bucket
keeps its size as the input grows. Queries probe the axes next in magnitude as well. How many tables
and probes are needed is read off the input: the true neighbours of ``SAMPLE`` queries are found by a
scan, and the cheapest setting that finds ``TARGET`` of them is taken (the last one offered probes
every bucket); as each table ships every vector once, while probes ship queries only, few tables and
many probes are cheap. Scores within a bounded sample of the vectors give every query a least score
that its nearest ones cannot fall below, so blocks return only rows that reach it. Where the sample is a
small part of the vectors it says little, and buckets are asked in steps: a few probes of the first table,
its others, then the other tables, three times as many as before in each step. What a query has
found raises its least score for the next step, so a step returns a few times ``k`` rows for a query,
however many vectors there are. A query that still finds fewer than ``k`` rows is answered by a scan, in such steps too. All
candidates of a bucket are scored exactly (double precision, original vectors), in blocks: the rows of
a bucket of more than ``BLOCK`` rows and the queries of one that more than ``QUERIES`` ask are dealt
over a grid of blocks, each row to all blocks of its line and each query to all of its column, so no
task holds a hot bucket or all queries; the scans are such grids too. Vectors travel, not pairs of
ids: a query has thousands of candidates, so pairs would be many times the bytes. Identical vectors (by a 128-bit digest) are one candidate that carries its smallest
ids, as ties go to smaller ids.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, as
query or candidate, nor do rows of another dimension than the most common one or without an id;
of rows with the same id and vector one takes part; fewer candidates than ``k`` give fewer rows;
empty tables give none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markscribe.llm.common import forget, map_arrow, map_batches, written

#: Least and most tables, least probes; mean rows and mean queries of a full block, least rows of the mean bucket.
TABLES, MOST_TABLES, PROBES, BLOCK, QUERIES, BUCKET = 2, 40, 10, 4096, 8192, 100
#: Rows of small tables (repeated vectors, large buckets) that are broadcast at most.
MOST_BROADCAST = 1 << 18
#: Queries whose true neighbours are scanned for, and the share of those that has to be found.
SAMPLE, TARGET = 96, 0.95
#: Vectors that are sent in about the time in which a query is compared with a whole block's rows (an estimate).
SCORED = 8
#: Vectors, chosen by hash of their ids, that give queries their least scores.
LEAST_FROM = 4096
#: From more than so many times LEAST_FROM vectors on buckets are asked in steps; probes of the first step, and how many times as many probes, or tables, are asked with each further one.
STEPS_FROM, FIRST, MORE_PROBES, MORE_TABLES = 4, 3, 16, 4


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotations(x: np.ndarray, number: int, seed: int = 11) -> np.ndarray:
    """The pseudo-rotation of this number of unit rows, padded to a power of two."""
    size = 1 << max(1, int(x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    rng = np.random.Generator(np.random.PCG64([seed, number]))
    for _ in range(3):
        y = _hadamard(y * rng.choice([-1.0, 1.0], size))
    return y


def plan(rows: int, dimension: int, bucket: int = BUCKET) -> list[int]:
    """Axes of each hash in a table, as many as bring the mean bucket near ``bucket`` rows: first those of one rotation, then of further ones."""
    size = 1 << max(1, int(dimension - 1).bit_length())
    power = lambda x: 1 << max(0, int(np.log2(max(1.0, x))))
    axes = [min(size, max(2, power(rows / bucket / 2)))]
    buckets = 2 * axes[0]
    while rows / buckets > 2 * bucket:
        axes.append(min(size, power(rows / buckets / bucket / 2)))
        buckets *= 2 * axes[-1]
    return axes


def codes(x: np.ndarray, table: int, axes: list[int], probes: int) -> np.ndarray:
    """Bucket numbers (rows, probes) of a table, nearest first; one probe is the vector's own bucket."""
    best = None
    for j, n in enumerate(axes):
        y = rotations(x, table * 16 + j)[:, :n]
        signed = np.concatenate([y, -y], axis=1)
        keep = min(probes, signed.shape[1])
        top = np.argsort(-signed, axis=1, kind="stable")[:, :keep]
        value = np.take_along_axis(signed, top, axis=1)
        loss = (value[:, :1] - value) ** 2
        if best is None:
            best, cost = top.astype(np.int64), loss
        else:
            # The i-th and j-th nearest together are at best the (i * j)-th nearest pair.
            i, j = np.nonzero(np.outer(np.arange(1, best.shape[1] + 1), np.arange(1, keep + 1)) <= probes)
            both, cost = best[:, i] * (2 * n) + top[:, j], cost[:, i] + loss[:, j]
            order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            best, cost = np.take_along_axis(both, order, axis=1), np.take_along_axis(cost, order, axis=1)
    return best


def settings(queries: np.ndarray, neighbours: np.ndarray, of: np.ndarray, rows: int, asked: int, tables: int = TABLES, probes: int = PROBES) -> tuple[list[int], int, int, float]:
    """Axes, tables and probes that cost least of those finding TARGET of the neighbours (unit rows; neighbour i is one of query ``of[i]``), and the share they find.

    The cost is in vectors sent: a table sends each row once for every ``QUERIES`` queries of its
    bucket and each query to every block of the buckets it probes; scoring a whole block costs as
    much as sending ``SCORED``. Probing every bucket is the last resort.
    """
    offered = []
    for bucket in (*(BUCKET << i for i in range(7)), rows):
        if (axes := plan(rows, queries.shape[1], bucket)) not in offered:
            offered.append(axes)
    best = None
    for axes in (*offered[-2::-1], offered[-1]):  # large buckets first: few tables find enough, which bounds what smaller ones may cost
        if best and axes is offered[-1]:
            break
        buckets = int(np.prod([2 * n for n in axes]))
        mean = max(1.0, rows / buckets)
        widths = sorted({min(buckets, probes << i) for i in range(8)} | ({buckets} if axes is offered[-1] else set()))
        place = np.full(len(of), widths[-1])  # of the neighbour's bucket among the query's probes, best of the tables so far
        for t in range(max(tables, MOST_TABLES)):
            own, asks = codes(neighbours, t, axes, 1)[:, 0], codes(queries, t, axes, widths[-1])
            hit = asks[of] == own[:, None]
            place = np.minimum(place, np.where(hit.any(axis=1), hit.argmax(axis=1), widths[-1]))
            if t + 1 < tables or t + 1 > 10 and t % 5:
                continue
            for width in widths:
                share = float((place < width).mean()) if len(of) else 1.0
                chunks = max(1, -(-(asked * width) // (buckets * QUERIES)))
                cost = (t + 1) * (rows * chunks + asked * width * (-(-mean // BLOCK) + SCORED * mean / BLOCK))
                if share >= TARGET and (best is None or cost < best[0]):
                    best = cost, axes, t + 1, width, share
            if best and (t + 2) * (rows + asked * widths[0] * (1 + SCORED * mean / BLOCK)) > best[0]:  # further tables cost more than the best setting
                break
    return best[1:]


def _top(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``q``, row of ``c`` and score of the k largest inner products of every row of ``q``, largest first, ties by id.

    A matrix product picks them with room for its rounding; the scores returned do not depend on the block.
    """
    score = q @ c.T
    if score.shape[1] > k:
        room = 1e-12 * np.abs(score).max(axis=1, keepdims=True)
        row, column = np.nonzero(score >= np.partition(score, -k, axis=1)[:, -k, None] - room)
    else:
        row, column = (x.ravel() for x in np.indices(score.shape))
    exact = np.einsum("ij,ij->i", q[row], c[column])
    order = np.lexsort((ids[column], -exact, row))
    row, column, exact = row[order], column[order], exact[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], column[kept], exact[kept]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of a list column, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension).astype(np.float64)


def true_neighbours(unique: DataFrame, x: np.ndarray, k: int) -> list:
    """n (row of ``x``), u and raw (doubles) of the k best scores of every row of ``x`` among ``unique(u, v)``, by a scan."""

    def run(batches):
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, x.shape[1])))
        for batch in batches:
            rows, ids = _matrix(batch.column(1), x.shape[1]), batch.column(0).to_numpy()
            n, at, score = _top(x, rows, ids, k)
            n, u, s, v = (np.concatenate(p) for p in zip(kept, (n, ids[at], score, rows[at]), strict=True))
            order = np.lexsort((u, -s, n))
            order = order[np.arange(len(order)) - np.searchsorted(n[order], n[order]) < k]
            kept = n[order], u[order], s[order], v[order]
        if len(kept[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in kept[:3]] + [pa.array([r.tobytes() for r in kept[3]], pa.binary())], ["n", "u", "score", "raw"])

    found = map_batches(unique.select("u", "v"), run, "n long, u long, score double, raw binary")
    ranked = found.withColumn("r", F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), "u")))
    return ranked.filter(F.col("r") <= k).select("n", "u", "raw").collect()


def valid_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, v (array of float or double) and key (x, y: a digest of v) of the rows that take part."""
    kind = "float" if dict(rows.dtypes)["embedding"] == "array<float>" else "double"
    v = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("v")).filter("vec_id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(~F.coalesce(bad, F.lit(False)) & F.exists("v", lambda x: x != 0))
    return v.select("vec_id", "v", F.struct(F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y")).alias("key"))


def small(table: DataFrame) -> DataFrame:
    """A table to join with: broadcast if it has at most MOST_BROADCAST rows."""
    return F.broadcast(table) if table.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else table


def distinct_vectors(valid: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """One row per vector (u: its smallest id, v), and the repeated ones' u and ids (their k + 1 smallest).

    Only digests and ids are shuffled, but for the vectors of repeated rows.
    """
    again = valid.groupBy("key").agg(F.count("*").alias("n"), F.min("vec_id").alias("u")).filter("n > 1").select("key", "u")
    again = small(written(again, "repeated"))
    ids = valid.select("vec_id", "key").join(again, "key").select("u", "vec_id").distinct()
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    ids = written(ids.groupBy("u").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "repeated-ids")
    once = valid.join(again, "key", "left_anti").select(F.col("vec_id").alias("u"), "v")
    first = valid.join(again, "key").filter("vec_id = u").groupBy("u").agg(F.first("v").alias("v"))
    return once.unionByName(first), ids


def ranges(n: int, first: int, more: int) -> list[tuple[int, int]]:
    """0 to ``n`` in runs (begin, end) that end at ``first`` and then ``more`` times as far each."""
    out = [(0, min(n, first))]
    while out[-1][1] < n:
        out.append((out[-1][1], min(n, more * out[-1][1])))
    return out


def steps(rows: int, tables: int, probes: int) -> list[tuple[int, int, int, int]]:
    """Tables (begin, end) and probes (begin, end) of each step; the first table's rows are sent once in each of its steps, the others' in one."""
    if rows <= STEPS_FROM * LEAST_FROM:
        return [(0, tables, 0, probes)]
    return [(0, 1, *p) for p in ranges(probes, FIRST, MORE_PROBES)] + [(*t, 0, probes) for t in ranges(tables, 1, MORE_TABLES)[1:]]


def bucket_sizes(own: DataFrame, asks: DataFrame) -> DataFrame:
    """step, t, code, parts (blocks that the bucket's rows need), chunks (blocks that its queries need) of the buckets where either is more than one; from counts (step, t, code, kind, n)."""
    both = own.unionByName(asks)
    need = lambda kind, most: F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)) / most).cast("int"))
    return both.groupBy("step", "t", "code").agg(need(0, BLOCK).alias("parts"), need(1, QUERIES).alias("chunks")).filter("parts > 1 or chunks > 1")


def dealt(own: DataFrame, asks: DataFrame) -> DataFrame:
    """Rows and queries with ``part`` and ``chunk``, their place in the bucket's grid of ``parts`` by ``chunks`` blocks (null: one); every row meets every query once."""
    parts, chunks = (F.coalesce(c, F.lit(1)) for c in ("parts", "chunks"))
    one = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = own.withColumn("part", one(parts)).withColumn("chunk", each(chunks))
    asks = asks.withColumn("chunk", one(chunks)).withColumn("part", each(parts))
    return own.drop("parts", "chunks").unionByName(asks.drop("parts", "chunks"))


def nearest(rows: DataFrame, every: int = 20, k: int = 20, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """The k nearest found of each query (vec_id divisible by ``every``): query_id, rank, vec_id, score.

    ``tables`` and ``probes`` are the least that are used.
    """
    valid = valid_vectors(rows)
    sizes = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return rows.sparkSession.createDataFrame([], schema)
    dimension, total = sizes[0]
    valid = valid.filter(F.size("v") == dimension)
    unique, repeated = distinct_vectors(valid, k)
    unique = written(unique, "unique")
    asked = written(valid.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "key", "v").dropDuplicates(["query_id", "key"]), "asked")
    basis = np.array([r.v for r in unique.orderBy(F.xxhash64("u"), "u").limit(LEAST_FROM).select("v").collect()], np.float64)

    def least(batch):
        """Adds the (k + 1)-th largest score of each row among the basis: candidates all, so the nearest k + 1 reach it."""
        x, bound = _matrix(batch.column(1), dimension), np.full(len(batch), -np.inf)
        if len(basis) > k and len(x):
            score = np.concatenate([x[at : at + 256] @ basis.T for at in range(0, len(x), 256)])
            bound = np.partition(score, -k - 1, axis=1)[:, -k - 1] - 1e-12 * np.abs(score).max(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound)], ["u", "v", "key", "least"])

    queries = asked.groupBy("key").agg(F.min("query_id").alias("u"), F.first("v").alias("v"))
    queries = written(map_arrow(queries.select("u", "v", "key"), least, f"u long, v {dict(valid.dtypes)['v']}, key struct<x:long,y:long>, least double"), "queries")
    some = queries.orderBy(F.xxhash64("u"), "u").limit(SAMPLE).collect()
    if not some:
        return rows.sparkSession.createDataFrame([], schema)
    x = np.array([r.v for r in some], np.float64)
    pairs = [r for r in true_neighbours(unique, x, k + 1) if r.raw != x[r.n].tobytes()]
    y = np.frombuffer(b"".join(r.raw for r in pairs)).reshape(len(pairs), dimension)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    axes, tables, probes, _ = settings(unit(x), unit(y), np.array([r.n for r in pairs], np.int64), total, max(1, total // every), tables, probes)
    kind_of = np.float32 if dict(valid.dtypes)["v"] == "array<float>" else np.float64
    shape = "t int, code long, kind int, id long, least double, raw binary"
    names = [c.split()[0] for c in shape.split(", ")]

    def raws(x):
        return pa.array([r.tobytes() for r in x.astype(kind_of)], pa.binary())

    def asked_of(y, t, kind, first, end):
        """The bucket that each unit row is in, or those that it asks, a column each."""
        return codes(y, t, axes, probes)[:, first:end] if kind else codes(y, t, axes, 1)

    def counted(kind: int):
        """How many rows of a batch are in (or ask for) each bucket."""

        def run(batch):
            x = unit(_matrix(batch.column(1), dimension))
            for i, (begin, stop, first, end) in enumerate(every_step):
                for t in range(begin, stop):
                    code, n = np.unique(asked_of(x, t, kind, first, end), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), c, np.int32)) for c in (i, t, kind)] + [pa.array(code), pa.array(n)], ["step", "t", "kind", "code", "n"])

        return run

    def hashed(kind: int, begin: int, stop: int, first: int, end: int):
        def run(batch):
            x = _matrix(batch.column(1), dimension)
            y, raw, bound = unit(x), raws(x), batch.column(2) if kind else pa.nulls(len(x), pa.float64())
            for t in range(begin, stop):
                for column in asked_of(y, t, kind, first, end).T:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(column), pa.array(np.full(len(x), kind, np.int32)), batch.column(0), bound, raw], names
                    )

        return run

    def bare(kind: int):
        def run(batch):
            x = _matrix(batch.column(1), dimension)
            zero = np.zeros(len(x), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(zero), pa.array(zero.astype(np.int64)), pa.array(zero + np.int32(kind)), batch.column(0), batch.column(2) if kind else pa.nulls(len(x), pa.float64()), raws(x)], names)

        return run

    # Buckets of more than a block's rows or queries: counted over codes alone, so that vectors are sent once a table.
    every_step = steps(total, tables, probes)
    sent = unique.select("u", "v"), queries.select("u", "v", "least")
    large = small(written(bucket_sizes(*(map_arrow(some, counted(kind), "step int, t int, kind int, code long, n long") for kind, some in enumerate(sent))), "large-buckets"))

    def block(group: pa.Table) -> pa.Table:
        kind, ids = group.column("kind").to_numpy(), group.column("id").to_numpy()
        x = np.frombuffer(b"".join(group.column("raw").to_pylist()), dtype=kind_of).reshape(len(ids), dimension).astype(np.float64)
        q, c = x[kind == 1], x[kind == 0]
        qi, ci = ids[kind == 1], ids[kind == 0]
        bound = group.column("least").to_numpy()[kind == 1]
        if not len(q) or not len(c):
            return pa.table({"q": pa.array([], pa.int64()), "u": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        parts = []
        for at in range(0, len(q), 256):
            row, column, score = _top(q[at : at + 256], c, ci, k + 1)
            far = score < bound[at + row]
            parts.append((qi[at + row][~far], ci[column][~far], score[~far]))
        return pa.table(dict(zip(("q", "u", "score"), (np.concatenate(p) for p in zip(*parts, strict=True)), strict=True)))

    def ranked(blocks: DataFrame, before: DataFrame | None) -> DataFrame:
        """q, u, score and r of the k + 1 nearest of blocks and of what was found before."""
        found = blocks.groupBy("t", "code", "part", "chunk").applyInArrow(block, "q long, u long, score double")
        found = found.unionByName(before.drop("r")) if before else found
        found = found.groupBy("q", "u").agg(F.max("score").alias("score"))
        found = written(found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "u"))).filter(F.col("r") <= k + 1), "nearest")
        if before:
            forget(before)
        return found

    def raised(some: DataFrame, best: DataFrame | None) -> DataFrame:
        """Queries (u, v, least) whose least score is the (k + 1)-th found so far, if that is larger."""
        if best is None:
            return some
        found = best.filter(F.col("r") == k + 1).select(F.col("q").alias("u"), F.col("score").alias("found"))
        return some.join(found, "u", "left").select("u", "v", F.greatest("least", "found").alias("least"))

    best = None
    for i, step in enumerate(every_step):
        here = large.filter(F.col("step") == i).drop("step")
        rows_and_queries = sent[0], raised(sent[1], best)
        best = ranked(dealt(*(map_arrow(some, hashed(kind, *step), shape).join(here, ["t", "code"], "left") for kind, some in enumerate(rows_and_queries))), best)
    repeated = small(repeated)
    best = best.join(repeated, "u", "left")
    enough = best.groupBy("q").agg(F.sum(F.coalesce(F.size("ids"), F.lit(1))).alias("n")).filter(F.col("n") > k).select("q")
    short = written(queries.join(enough, F.col("u") == F.col("q"), "left_anti").select("u", "v", "least"), "short")
    if lacking := short.count():
        parts, scanned = -(-total // BLOCK), None
        grid = {"t": F.lit(-1), "parts": F.lit(parts), "chunks": F.lit(-(-lacking // QUERIES))}
        for begin, stop in ranges(parts, 1, MORE_TABLES) if total > STEPS_FROM * LEAST_FROM else [(0, parts)]:
            among = lambda column: column.between(begin, stop - 1)  # noqa: E731, B023
            rows_and_queries = sent[0].filter(among(F.pmod(F.xxhash64("u"), F.lit(parts)))), raised(short, scanned)
            blocks = dealt(*(map_arrow(some, bare(kind), shape).withColumns(grid) for kind, some in enumerate(rows_and_queries)))
            scanned = ranked(blocks.filter(among(F.col("part"))), scanned)
        best = best.join(short.select(F.col("u").alias("q")), "q", "left_anti").unionByName(scanned.join(repeated, "u", "left"))
    wide = best.select("q", "score", F.explode(F.coalesce("ids", F.array("u"))).alias("vec_id"))
    wide = wide.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1).drop("r")
    out = asked.join(queries.select("key", F.col("u").alias("q")), "key").select("query_id", "q").join(wide, "q").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
