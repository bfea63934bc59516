"""Canonical questions from Markdown model answers and question papers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markscribe.config import Question, QuestionFormatError
from markscribe.functions.text import LINE_ENDS, ND, WS, integer_in, match_spans, uni_strip

# The grammar of headings, marks and inline markers.
HEAD = rf"(?iu)\A{WS}*#+{WS}*Q{WS}*\.?{WS}*({ND}+)"
HEADING = rf"(?iu)\A{WS}*#+{WS}*Q{WS}*\.?{WS}*({ND}+){WS}*(?:[.):\-]|{WS}){WS}*(.*?)(?:{WS}*\[({ND}+){WS}*(?:marks?)?\]{WS}*)?\z"
#: Over a whole text: white space may cross line ends, the body ends with its line.
PAPER_HEADINGS = rf"(?imud)^{WS}*#+{WS}*(?:Q{WS}*\.?{WS}*{ND}+|Question{WS}*(?:No\.?{WS}*)?{ND}+){WS}*[.) :\-]?{WS}*.*$"
PAPER_HEADING = rf"(?iud)\A{WS}*#+{WS}*(Q{WS}*\.?{WS}*{ND}+|Question{WS}*(?:No\.?{WS}*)?{ND}+){WS}*[.) :\-]?{WS}*(.*)\z"
MARKS = rf"(?iu)(?:\[{WS}*{ND}+{WS}*(?:marks?)?{WS}*\]|\({WS}*{ND}+{WS}*(?:marks?)?{WS}*\)|\b(?:max{WS}+)?marks?{WS}*[:\-]?{WS}*{ND}+|\b{ND}+{WS}*M\b)"
INLINE = rf"(?iu)(?<![A-Za-z0-9])(?:Q{WS}*\.?{WS}*{ND}+|Question{WS}*(?:No\.?{WS}*)?{ND}+|{ND}+{WS}*[.):]){WS}*[.) :\-]?"
INSTRUCTION = rf"(?iu)\A(?:answer all|attempt any|section{WS}|total marks|time{WS}|page{WS}|continued)"
FIELDS = ("ord", "question_id", "number", "question_text", "max_marks", "model_answer")


def _last_wins(rows: DataFrame, key: str) -> DataFrame:
    """One row per document and id: the last one's values at the first one's place."""
    w = W.partitionBy(key, "question_id")
    rows = rows.withColumn("_last", F.max("at").over(w)).withColumn("_first", F.min("at").over(w)).filter("at = _last")
    return rows.withColumn("ord", F.row_number().over(W.partitionBy(key).orderBy("_first"))).select(key, *FIELDS)


def _integer(text: Column) -> Column:
    return integer_in(text).try_cast("int")


def _lines(text: str) -> Column:
    return F.split(F.regexp_replace(text, r"\r\n?", "\n"), LINE_ENDS, -1)


def parse_model_answers(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, ord, question_id, number, question_text, max_marks, model_answer of each Markdown file."""
    lines = texts.select(key, F.posexplode(_lines(text)).alias("at", "line"))
    by = W.partitionBy(key).orderBy("at")
    lines = lines.withColumn("section", F.sum(F.col("line").rlike(HEAD).cast("int")).over(by)).filter("section > 0")
    heads = lines.filter(F.col("line").rlike(HEADING)).select(
        key, "section", "at", _integer(F.regexp_extract("line", HEADING, 1)).alias("number"),
        uni_strip(F.regexp_extract("line", HEADING, 2)).alias("question_text"), _integer(F.regexp_extract("line", HEADING, 3)).alias("max_marks"),
    )
    body = lines.withColumn("_head", F.row_number().over(W.partitionBy(key, "section").orderBy("at"))).filter("_head > 1")
    right = F.regexp_replace("line", rf"{WS}+\z", "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", right.alias("l")))), lambda x: x["l"]), "\n")
    answers = body.groupBy(key, "section").agg(uni_strip(joined).alias("model_answer"))
    rows = heads.join(answers, [key, "section"], "left").withColumn("model_answer", F.coalesce("model_answer", F.lit("")))
    rows = rows.filter("question_text <> '' or model_answer <> ''").withColumn("question_id", F.concat(F.lit("Q"), F.col("number")))
    return _last_wins(rows, key)


def _without_marks(body: Column) -> tuple[Column, Column]:
    """Marks of the last marks expression, and the body without it."""
    last = F.try_element_at(match_spans(body, MARKS), F.lit(-1))
    rest = F.when(last.isNull(), body).otherwise(uni_strip(F.concat(F.substr(body, F.lit(1), last["start"]), F.substr(body, last["end"] + 1))))
    return _integer(last["text"]), rest


def parse_question_paper(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """Questions of headings, else of inline markers."""
    texts = texts.select(key, F.regexp_replace(text, r"\r\n?", "\n").alias(text))
    heads = texts.select(key, F.posexplode(match_spans(F.col(text), PAPER_HEADINGS)).alias("at", "m")).withColumn("head", F.col("m.text"))
    marks, body = _without_marks(uni_strip(F.regexp_extract("head", PAPER_HEADING, 2)))
    headed = heads.select(key, "at", _integer(F.regexp_extract("head", PAPER_HEADING, 1)).alias("number"), body.alias("question_text"), marks.alias("max_marks")).filter("question_text <> ''")
    rest = texts.join(headed.select(key).distinct(), key, "left_anti").withColumn("_m", match_spans(F.col(text), INLINE))
    spans = rest.select(key, F.col(text).alias("_t"), F.col("_m"), F.posexplode("_m").alias("at", "m"))
    end = F.coalesce(F.get("_m", F.col("at") + 1)["start"], F.length("_t"))
    marks, body = _without_marks(uni_strip(F.substr("_t", F.col("m.end") + 1, end - F.col("m.end"))))
    inline = spans.select(key, "at", _integer(F.col("m.text")).alias("number"), body.alias("question_text"), marks.alias("max_marks"))
    inline = inline.filter((F.col("question_text") != "") & ~F.col("question_text").rlike(INSTRUCTION)).withColumn("question_text", F.regexp_replace("question_text", f"{WS}+", " "))
    rows = headed.unionByName(inline).withColumn("question_id", F.concat(F.lit("Q"), F.col("number"))).withColumn("model_answer", F.lit(None).cast("string"))
    return _last_wins(rows, key)


def questions_of(rows: DataFrame) -> list[Question]:
    """The canonical questions of one file (a small dimension) for the engine."""
    return [Question(r.number, r.question_text, r.max_marks, r.model_answer) for r in rows.orderBy("ord").collect()]


def load_model_answers(rows: DataFrame, key: str = "path") -> DataFrame:
    """key, answers map<question_id, model answer> of ``parse_model_answers``' rows; a missing answer is empty."""
    entry = F.struct("question_id", F.coalesce("model_answer", F.lit("")))
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("answers"))


def read_questions(spark: SparkSession, path: str, paper: bool = False) -> list[Question]:
    """The canonical questions of a Markdown file, model answers or a question paper; none if it is missing, an error if it is not UTF-8."""
    try:
        file = spark.read.format("binaryFile").load(path).withColumn("text", F.col("content").cast("string"))
        if not file.filter(~F.is_valid_utf8("text")).isEmpty():
            raise QuestionFormatError(f"not valid UTF-8: {path}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    text = file.select(F.lit(path).alias("path"), "text")
    return questions_of((parse_question_paper if paper else parse_model_answers)(text))
