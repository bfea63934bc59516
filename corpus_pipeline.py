"""Corpus preparation: quality classifier, quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a
DataFrame; all but the last return the columns of documents, extra ones included. An empty table
passes every stage.

Repeated ids: every row is judged by its own text. Of rows that share id and text one stays; rows
that share an id but not a text are documents of their own. Rows without a doc_id pass the
near-duplicate stage, texts without words link with nothing and pass it too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markscribe.llm import classifier, jaccard, packing, quality_rules, queries, secret_scan
from markscribe.llm.common import delete, scratch, shared_dir, table, written

#: Keys of rows that go that are broadcast at most.
MOST_BROADCAST = 1 << 18


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality stay."""
    model = classifier.fit(docs, classifier.learning_rows(table(spark, sf_dir, "labels")))
    bare = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    scored = classifier.score_documents(bare, model, text=f"c{docs.columns.index('text')}")
    return scored.filter(F.col("score") >= classifier.THRESHOLD).drop("score").toDF(*docs.columns)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio stay."""
    return quality_rules.kept_documents(docs, queries.trusted_rows(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest id stays."""
    found = written(jaccard.groups(docs.select("doc_id", "text")), "groups")
    few = lambda keys: F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys
    key = ["doc_id", "t1", "t2"]
    gone = few(written(found.filter("not stays").select(*key).distinct(), "gone"))
    own = found.filter("stays and doc_id is not null and n_shingles > 0")
    again = few(written(own.groupBy(*key).count().filter("count > 1").select(*key), "again"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).select("*", F.col(names[docs.columns.index("doc_id")]).cast("long").alias("doc_id"), F.col(names[docs.columns.index("text")]).alias("text"))
    rows = rows.select(*names, "doc_id", *jaccard.text_key()).join(gone, key, "left_anti")
    same = Window.partitionBy(*key).orderBy(F.to_json(F.struct(*names)))
    one = rows.join(again, key, "left_semi").withColumn("_row", F.row_number().over(same)).filter("_row = 1")
    return rows.join(again, key, "left_anti").select(*names).unionAll(one.select(*names)).toDF(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; n_chars is that of the new text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack_documents(docs, queries.WORDS)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("packing", packing_stage),
]
#: Hashed models and tokenizers have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result written to the shared folder and read again; scratch of earlier stages is deleted."""
    docs = table(spark, sf_dir, "documents")
    where = f"{shared_dir(spark)}/markscribe-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(f"{where}/{k}")
        if k:
            delete(spark, f"{where}/{k - 1}")
        docs = spark.read.parquet(f"{where}/{k}")
    return docs
