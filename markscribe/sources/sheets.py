"""Answer sheets from a directory of text files, and one JSON file per student."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markscribe.functions.text import uni_strip
from markscribe.sources.files import register


def sheet_rows(files: DataFrame) -> DataFrame:
    """student_id, raw_text (null if malformed), path of the .txt files among ``files(path, content)``."""
    files = files.withColumn("name", F.try_element_at(F.split("path", "/"), F.lit(-1))).filter(F.lower("name").endswith(".txt") & ~F.col("name").startswith("."))
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.regexp_replace(F.when(valid, F.decode("content", "UTF-8")), r"\r\n?", "\n")
    return files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("student_id"), text.alias("raw_text"), "path")


def nonblank(rows: DataFrame, text: str = "raw_text") -> DataFrame:
    return rows.filter(F.col(text).isNotNull() & (F.length(uni_strip(F.col(text))) > 0))


def scan_sheets(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(sheets, errors): student_id, raw_text, path of the readable, non-blank .txt files, and path, error of the others.

    ``path`` tells sheets apart; files that differ in their suffix's case share a student_id.
    """
    register(spark)
    rows = spark.read.format("markscribe_sheets").load(directory)
    return nonblank(rows).select("student_id", "raw_text", "path"), rows.filter("error is not null").select("path", "error")


def file_names(results: DataFrame, key: str = "student_id", source: str = "path") -> DataFrame:
    """Add ``file_name``: the key; of rows that share it only the last in order of ``source`` has it, the others add their source's name and a checksum of it."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(source))) == 1
    name = F.try_element_at(F.split(source, "/"), F.lit(-1))
    return results.withColumn("file_name", F.when(last, F.col(key)).otherwise(F.concat_ws("-", name, F.lower(F.hex(F.crc32(F.col(source).cast("binary")))))))


def write_student_files(results: DataFrame, directory: str, name: str = "file_name", minimal: str = "minimal", debug: str = "debug") -> None:
    """One ``<name>.json`` and ``debug/<name>_debug.json`` per row, UTF-8, indented, overwritten; all appear when the job has ended well."""
    register(results.sparkSession)
    files = F.array(F.struct(F.concat(name, F.lit(".json")).alias("name"), F.col(minimal).alias("text")), F.struct(F.concat(F.lit("debug/"), name, F.lit("_debug.json")).alias("name"), F.col(debug).alias("text")))
    results.select(F.explode(files).alias("f")).select("f.name", "f.text").write.format("markscribe_json").mode("append").save(directory)
