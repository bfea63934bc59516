"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw corpus, with SQL functions only.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Unigrams and bigrams are hashed (XXH64) to buckets, whose
number grows as the cube root of the text counted (``PER_ROOT`` for each root of a byte): n-grams
that tell corpora apart are frequent ones, whose counts grow with the text, faster than those of the
rare ones that share their bucket. Two multinomials, over the trusted rows and over all rows, are
counted in one pass with add-one smoothing. A document's score is the sum of its n-grams' log ratios
over their number, in thousandths as integers, so that it does not depend on the order of summation.
A document is kept if no base rule fails and its score reaches ``least``.

A ratio table of at most ``MOST_ARRAY`` buckets reaches the rows as one array; a larger one stays a table
that the n-grams of the distinct texts are joined to by bucket. Trusted ids are broadcast up to
``MOST_BROADCAST`` rows and joined by a shuffle beyond.

Defined cases: null or empty text has no words, fails the base rules and has a null score; repeated
rows count each; with no trusted rows the target is uniform; a score equal to the threshold is kept;
extra columns come back untouched, and a result whose name an input column has is called
``quality_`` and that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.functions.text import once
from markscribe.llm.common import spread, written

#: Least buckets, buckets for each cube root of a byte of text, most buckets that reach the rows as an array, buckets that are ordered together.
BUCKETS, PER_ROOT, MOST_ARRAY, CHUNK = 1 << 16, 480, 1 << 25, 1 << 12
#: Least mean log ratio that is kept, in thousandths.
LEAST = -120
MOST_BROADCAST = 1 << 20
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, though ``use`` refers to it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _windows(hashes: Column, n: int) -> Column:
    """Hashes of all windows of n words."""
    size = F.size(hashes)
    windows = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*(hashes[i + k] for k in range(n))))
    return F.when(size >= n, windows).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""

    def covered(grams: Column) -> Column:
        ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = let(
            ordered,
            lambda s: F.filter(s, lambda x, i: F.get(s, i - 1)["g"].eqNullSafe(x["g"]) | F.get(s, i + 1)["g"].eqNullSafe(x["g"])),
        )
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"), (p + 3).alias("end"))
        return F.aggregate(starts, zero, step, lambda acc: acc["n"])

    grams = let(hashes, lambda h: _windows(h, 3))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g)))


def with_base_counts(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the base counts and ``_hashes``, the words' hashes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counts = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    out = docs.withColumn("_words", words_of(F.col("text"))).withColumn("_hashes", once(F.transform("_words", lambda w: F.xxhash64(w))))
    return out.select(*docs.columns, counts.alias("_c"), "_hashes").select(*docs.columns, "_c.*", "_hashes")


def bucket_count(docs: DataFrame) -> int:
    """The buckets for these rows: a power of two that grows with their text."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(BUCKETS, 1 << (int(PER_ROOT * size ** (1 / 3)) | 1).bit_length() - 1)


def _grams(hashes: Column) -> Column:
    """Hashes of the unigrams and bigrams."""
    return let(hashes, lambda h: F.concat(h, _windows(h, 2)))


def _bucket(hashed: Column, buckets: int) -> Column:
    return hashed.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int" if buckets <= 1 << 31 else "long")


def marked_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with ``_trusted``; the ids are broadcast only if they are at most MOST_BROADCAST."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("_id")).dropna().distinct().withColumn("_t", F.lit(1))
    if trusted.count() <= MOST_BROADCAST:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"] == ids["_id"], "left").withColumn("_trusted", F.coalesce("_t", F.lit(0))).drop("_id", "_t")


def ratio_table(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """``b`` and ``ratio`` (log ratio in thousandths, counted over all rows) of every bucket, beyond MOST_ARRAY of those with n-grams."""
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    grams = marked_trusted(docs.select("doc_id", "text"), trusted).select("_trusted", F.explode(_grams(hashes)).alias("h"))
    grams = grams.select(_bucket(F.col("h"), buckets).alias("b"), F.col("_trusted").cast("long").alias("t"), F.lit(1).cast("long").alias("r"))
    if buckets <= MOST_ARRAY:  # an array has all of them
        zero = F.lit(0).cast("long")
        grams = grams.unionByName(docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"), zero.alias("t"), zero.alias("r")))
    counts = written(grams.groupBy("b").agg(F.sum("t").alias("t"), F.sum("r").alias("r")), "gram-counts")
    nt, nr = counts.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("r"), F.lit(0))).first()
    logs = lambda n, total: F.log((n + 1) / F.lit(total + buckets))
    return counts.select("b", F.round(1000 * (logs(F.col("t"), nt) - logs(F.col("r"), nr))).cast("short").alias("ratio"))


def ratio_array(ratios: DataFrame) -> Column:
    """The table as array<smallint>: the ratio of bucket b is at [b]."""
    ordered = lambda key, value: F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value])
    chunks = ratios.groupBy(F.floor(F.col("b") / CHUNK).cast("int").alias("chunk")).agg(ordered("b", "ratio").alias("inner"))
    return chunks.agg(F.flatten(ordered("chunk", "inner")).alias("ratios")).scalar()


def text_key(text: Column) -> Column:
    """128 bits that stand for the text."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def joined_sums(docs: DataFrame, table: DataFrame, buckets: int) -> DataFrame:
    """``_key`` of every distinct text with words and ``_sum``, its n-grams' ratios, by a join on the bucket."""
    texts = docs.filter("text is not null").select(text_key(F.col("text")).alias("_key"), "text").dropDuplicates(["_key"])
    grams = texts.select("_key", F.explode(_grams(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))).alias("h"))
    grams = grams.select("_key", _bucket(F.col("h"), buckets).alias("b"))
    each = grams.groupBy("_key", "b").count()
    return each.join(table, "b").groupBy("_key").agg(F.sum(F.col("count") * F.col("ratio")).alias("_sum"))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _scored(docs: DataFrame, trusted: DataFrame, least: int) -> DataFrame:
    """The columns of ``docs`` as c0, c1, … and the results under names of their own."""
    given = docs.columns
    row = spread(docs).toDF(*(f"c{i}" for i in range(len(given))))
    docs = row.select(*row.columns, F.col(f"c{given.index('doc_id')}").alias("doc_id"), F.col(f"c{given.index('text')}").cast("string").alias("text"))
    buckets = bucket_count(docs)
    ratios = ratio_table(docs, trusted, buckets)
    counted = with_base_counts(docs)
    if buckets <= MOST_ARRAY:
        # A column of its own, as a function with a lambda may not hold a subquery; referred to once, it is put in place, not copied to the rows.
        counted = counted.withColumn("_ratios", ratio_array(ratios))
        total = F.transform(F.array("_ratios"), lambda t: F.aggregate(_grams(F.col("_hashes")), F.lit(0).cast("long"), lambda acc, h: acc + t[_bucket(h, buckets)]))[0]
    else:
        sums = written(joined_sums(docs.select("text"), ratios, buckets), "gram-sums")
        counted = counted.withColumn("_key", text_key(F.col("text"))).join(sums.withColumnRenamed("_sum", "_joined"), "_key", "left").drop("_key")
        total = F.coalesce("_joined", F.lit(0).cast("long"))
    n = F.greatest(F.lit(0), 2 * F.col("n_words") - 1)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = (
        counted.select(*counted.columns, total.alias("_sum")).drop("_ratios", "_joined")
        .withColumn("n_repeat_words", repeated_words(F.col("_hashes")).cast("long"))
        .drop("_hashes")
        .withColumn("base_failed", failed)
        .withColumn("score", F.when(n > 0, F.col("_sum") / n))
        .withColumn("kept", once(~F.col("base_failed") & (F.col("_sum") >= least * n)))
    )
    return scored.select(*row.columns, *RESULTS)


def score_documents(docs: DataFrame, trusted: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with base counts, ``base_failed``, ``score`` (mean log ratio, thousandths) and ``kept``."""
    taken = {c.lower() for c in docs.columns}
    return _scored(docs, trusted, least).toDF(*docs.columns, *(f"quality_{c}" if c in taken else c for c in RESULTS))


def kept_documents(docs: DataFrame, trusted: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the likelihood ratio."""
    return _scored(docs, trusted, least).filter("kept").drop(*RESULTS).toDF(*docs.columns)
