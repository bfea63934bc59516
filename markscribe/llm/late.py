"""Overwriting the days that late rows touch, by deletion vectors.

A layout is a folder of Parquet files, ``day=D/file_no=K``: each day sorted and cut into files of equal
numbers of rows. Rows are dealt by range to sorted parts that are written once; a row's place in its
day then follows from its place in its part and a count per part and day, so no task sees a whole day.

Late rows: their ids are joined to the stored ids, and the stored rows' ``_metadata.row_index`` are
marked as outgoing, per file and block of 32,768 rows, in bitmaps (the deletion vectors). The affected
days are those of outgoing and of incoming rows. Their survivors (stored rows that no bitmap masks) and
the incoming rows are merged, cut anew, written beside the layout, and moved into it day by day; each
move can be repeated after a failure, and files of other days are never touched.

Defined cases: the latest-arrived row of an id stays (no arrival is the earliest; ties: the largest
sold_at, then the other columns in order); rows without an id are rows of one id; no sold_at is day -1;
an empty table gives a layout without files. The rows' own columns are written as they are; columns
named like the layout's own (day, file_no, names beginning with an underscore) are refused.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from markscribe.llm.common import delete, map_batches, scratch, shared_dir, written

BLOCK = 1 << 15  # rows that one bitmap covers
#: The contract's cut between early and late rows, and its number of files a table, about.
CUTOFF, FILES = datetime(2024, 3, 20), 1100


def crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def day(at: str | Column = "sold_at") -> Column:
    return F.coalesce(F.datediff(F.col(at) if isinstance(at, str) else at, F.lit("1970-01-01").cast("date")).cast("long"), F.lit(-1).cast("long"))


def with_corrections(sales: DataFrame) -> DataFrame:
    """The rows and the contract's copies of some of them: later, and with another total."""
    h = crc(F.col("sale_id").cast("string"))
    days = lambda n: F.make_dt_interval(n.cast("int"))
    new = {"total": F.col("total") + 1, "sold_at": F.col("sold_at") + days(h % 2), "arrived_at": F.col("arrived_at") + days(1 + h % 97)}
    own = F.struct(*sales.columns)
    copy = F.struct(*(new.get(c, F.col(c)).cast(sales.schema[c].dataType).alias(c) for c in sales.columns))
    copied = (h % 3 == 0) & (day() % 4 == 0)
    return sales.select(F.explode(F.when(copied, F.array(own, copy)).otherwise(F.array(own))).alias("r")).select("r.*")


def latest(rows: DataFrame, key: str = "sale_id", at: str = "arrived_at", then: str = "sold_at") -> DataFrame:
    """The latest-arrived row of each id; map tasks pre-aggregate."""
    order = [at, then, *(c for c in rows.columns if c not in (key, at, then))]
    best = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*(F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns))


def cut_days(rows: DataFrame, size: int, order: tuple[str, ...] = ("sold_at", "sale_id")) -> DataFrame:
    """``rows`` with ``day`` and ``file_no``; rows of a file go to one task, sorted."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["day", *order]
    parted = written(rows.withColumn("day", day()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys), "ranges")
    placed = parted.select("*", F.col("_metadata.file_name").alias("_part"), F.col("_metadata.row_index").alias("_at"))
    counts = placed.groupBy("day", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"), F.min(F.struct(*order)).alias("_low"))
    before = Window.partitionBy("day").orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("day", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    filed = placed.join(starts, ["day", "_part"]).withColumn("file_no", F.expr(f"(_start + _at) div {size}"))
    return filed.select(*rows.columns, "day", "file_no").repartition(parts, "day", "file_no").sortWithinPartitions("day", "file_no", *order)


def write_files(cut: DataFrame, path: str) -> None:
    cut.write.option("maxRecordsPerFile", 0).partitionBy("day", "file_no").parquet(path)


def read_layout(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a layout with day and file_no."""
    return spark.read.schema(StructType([*schema.fields, StructField("day", LongType()), StructField("file_no", LongType())])).parquet(path)


def deletion_vectors(stored: DataFrame, ids: DataFrame, key: str = "sale_id") -> DataFrame:
    """day, file_no, _block, _bits of the stored rows whose id is among the distinct ``ids``; ``stored`` has _row, their place in the file."""
    out = stored.select(key, "day", "file_no", "_row").join(ids.select(F.col(key).alias("_id")), F.col(key).eqNullSafe(F.col("_id")), "left_semi")
    return out.groupBy("day", "file_no", F.expr(f"_row div {BLOCK}").alias("_block")).agg(F.bitmap_construct_agg(F.col("_row") % BLOCK).alias("_bits"))


def masked(bits: str, row: str) -> Column:
    """Whether a row's bit is set in its block's bitmap (null: no bitmap)."""
    at = F.col(row) % BLOCK
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1, F.lit(False))


def _swap(spark: SparkSession, path: str, stage: str, days: list[int]) -> None:
    """Each day's folder gives way to the staged one, or to none; a day that was moved already is left as it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in days:
        old, new = hadoop(f"{path}/day={d}"), hadoop(f"{stage}/day={d}")
        if files.exists(new):
            files.delete(old, True)
            if not files.rename(new, old):
                raise OSError(f"cannot move {new}")
        elif not files.exists(hadoop(f"{stage}/moved-{d}")):
            files.delete(old, True)
        files.mkdirs(hadoop(f"{stage}/moved-{d}"))


def overwrite_late(path: str, late: DataFrame, size: int, key: str = "sale_id", at: str = "arrived_at") -> list[int]:
    """Bring ``late`` rows into the layout at ``path``; the days whose files were rewritten (calendar days, no more than the layout has)."""
    spark, columns = late.sparkSession, late.columns
    with scratch():
        new = written(latest(late, key, at), "late")
        stored = read_layout(spark, path, late.schema).withColumn("_row", F.col("_metadata.row_index"))
        # an id whose stored row is later stays as it is
        held = stored.select(F.col(key).alias("_key"), F.struct(at, "sold_at").alias("_held"))
        newer = F.col("_held").isNull() | (F.struct(at, "sold_at") >= F.col("_held"))
        incoming = written(new.join(held, F.col(key).eqNullSafe(F.col("_key")), "left").filter(newer).select(*columns), "incoming")
        vectors = written(deletion_vectors(stored, incoming, key), "vectors")
        days = [r.day for r in vectors.select("day").union(incoming.select(day().alias("day"))).distinct().orderBy("day").collect()]
        if not days:
            return []
        there = stored.filter(F.col("day").isin(days)).withColumn("_block", F.expr(f"_row div {BLOCK}"))
        survivors = there.join(vectors, ["day", "file_no", "_block"], "left").filter(~masked("_bits", "_row")).select(*columns)
        stage = f"{path}-stage"
        write_files(cut_days(survivors.unionByName(incoming), size), stage)
        _swap(spark, path, stage, days)
        delete(spark, stage)
    return days


def file_digests(spark: SparkSession, path: str, schema: StructType, rewritten: list[int]) -> DataFrame:
    """One row per file of a layout; its rows are read in order by one task, streaming."""
    rows = read_layout(spark, path, schema)
    micros = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")).cast("string"), F.lit(""))
    line = F.concat_ws(":", F.coalesce(F.col("sale_id").cast("string"), F.lit("")), micros("sold_at"), micros("arrived_at"))
    cents = F.coalesce(F.floor(100 * F.col("total") + 0.5).cast("long"), F.lit(0).cast("long"))
    slim = rows.select("day", "file_no", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), "sale_id", cents.alias("cents"), crc(line).alias("crc"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = slim.repartition(parts, "day", "file_no").sortWithinPartitions("day", "file_no", "path", "row")

    def run(batches):
        now, sums, ids = None, None, None

        def row():
            return pa.RecordBatch.from_pylist([dict(zip(names, (*now, *sums, ids.hexdigest()), strict=True))], out)

        for batch in batches:
            d, f, p, _, s, c, r = (x.to_pylist() for x in batch.columns)
            at = 0
            while at < len(d):
                end = at + 1
                while end < len(d) and p[end] == p[at]:
                    end += 1
                texts = ",".join("" if x is None else str(x) for x in s[at:end])
                if now is not None and now[2] == p[at]:
                    ids.update(b",")
                else:
                    if now is not None:
                        yield row()
                    now, sums, ids = (d[at], f[at], p[at]), [0, 0, 0], hashlib.sha256()
                ids.update(texts.encode())
                sums[0] += end - at
                sums[1] += sum(c[at:end])
                sums[2] += sum(r[at:end])
                at = end
        if now is not None:
            yield row()

    names = ["day", "file_no", "path", "n_rows", "cents", "rows_crc", "ids_sha256"]
    out = pa.schema([(n, pa.string() if n in ("path", "ids_sha256") else pa.int64()) for n in names])
    found = map_batches(slim, run, ", ".join(f"{n} {'string' if n in ('path', 'ids_sha256') else 'long'}" for n in names))
    return found.withColumn("rewritten", F.col("day").isin(rewritten) if rewritten else F.lit(False))


def overwritten_sales(spark: SparkSession, sales: DataFrame, cutoff: datetime = CUTOFF, files: int = FILES) -> DataFrame:
    """The contract: the layout of the early rows in a new shared folder, late rows brought in, one row per final file."""
    own = [c for c in sales.columns if c in ("day", "file_no") or c.startswith("_")]
    if own:
        raise ValueError(f"columns named like the layout's own: {own}")
    size = 1 + sales.count() // files
    rows = with_corrections(sales)
    early = F.coalesce(F.col("arrived_at") < F.lit(cutoff).cast(sales.schema["arrived_at"].dataType), F.lit(False))
    path = f"{shared_dir(spark)}/markscribe-sales-{uuid.uuid4().hex}"
    with scratch():
        write_files(cut_days(latest(rows.filter(early)), size), path)
    days = overwrite_late(path, rows.filter(~early), size)
    there = columns_of(spark, path, sales)
    return file_digests(spark, path, sales.schema, days).withColumn("columns", F.lit(",".join(there)))


def columns_of(spark: SparkSession, path: str, sales: DataFrame) -> list[str]:
    """The columns that the files of a layout have, all files' footers read."""
    if read_layout(spark, path, sales.schema).isEmpty():
        return sales.columns
    found = spark.read.option("mergeSchema", True).parquet(path).columns
    return [c for c in found if c not in ("day", "file_no")]
