import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from markscribe.config import EngineConfig, Question
from markscribe.functions.text import normalize_text, once
from markscribe.operators import decisions as D
from markscribe.operators.legacy import PatternDetector, is_question_line, normalize_label, segment
from markscribe.operators.markers import detect_candidates, preamble_bounds, preamble_is_header, preamble_is_meaningful
from markscribe.plans import queries as Q
from markscribe.plans.adjudicate import adjudicate, is_reply, structure_with
from markscribe.plans.batch import configure_log, run_batch
from markscribe.plans.pipeline import detect, structure_sheets
from markscribe.sources.canon import load_model_answers, parse_model_answers, parse_question_paper, read_questions
from markscribe.sources.sheets import scan_sheets
from markscribe.streaming.sheets import stream_sheets

SF = "/root/testdata/sf0.001"
THREE = [Question(1, "one"), Question(2, "two"), Question(4, "four")]
MAPPING = "sheet_id long, operation string, pos int, decision string, question_id string, confidence double, requires_human_review boolean, subject_match boolean"


def run(spark, text, questions=THREE, mapping=(), on=True):
    sheets = spark.createDataFrame([(1, text)], "sheet_id long, raw_text string")
    rows = [(1, "mapping", i + 1, "mapped", q, 0.95, False, True) for i, q in enumerate(mapping)]
    decisions = spark.createDataFrame(rows, MAPPING) if on else None
    row = structure_sheets(sheets, questions, EngineConfig(adjudicate=on, exam_id="e"), decisions).first()
    return row, {q.question_id: q.answers for q in row.questions}


def test_years_and_inner_lists_stay_in_the_answer(spark):
    row, answers = run(spark, "Q1 It was 1991.\n1.\ninner\nQ2 next", mapping=("Q1", "Q2"))
    assert answers == {"Q1": ["It was 1991.\n1.\ninner"], "Q2": ["next"], "Q4": []}
    assert row.audit.boundary_calls == 0


def test_order_does_not_matter_for_strong_markers(spark):
    _, answers = run(spark, "Q1 a\nQ4) d\nQuestion No. 2 b", mapping=("Q1", "Q4", "Q2"))
    assert answers == {"Q1": ["a"], "Q2": ["b"], "Q4": ["d"]}


def test_page_lines_are_not_boundaries(spark):
    row, answers = run(spark, "Q1 text\nFigure 3.2\nTable 4.1\nPage 12.\nmore", mapping=("Q1",))
    assert answers["Q1"] == ["text\nFigure 3.2\nTable 4.1\nPage 12.\nmore"] and row.review == []


def test_duplicate_attempts_become_a_list(spark):
    row, answers = run(spark, "Q1 first\nQ1 second", mapping=("Q1", "Q1"))
    assert answers["Q1"] == ["first", "second"]
    assert '"exam_id":"e"' in spark.createDataFrame([row], structure_schema(spark)).select(Q.minimal_json(F.col("sheet_id"))).first()[0]


def structure_schema(spark):
    sheets = spark.createDataFrame([(1, "x")], "sheet_id long, raw_text string")
    return structure_sheets(sheets, THREE, EngineConfig(adjudicate=True, exam_id="e"), spark.createDataFrame([], MAPPING)).schema


def test_numbered_run_is_not_asked_about(spark):
    row, answers = run(spark, "Q1 a\n1. x\n2. y\n3. z\n4. w\n5. v\nQ2 b\n1. p\n2. q\nQ4 d", mapping=("Q1", "Q2", "Q4"))
    assert row.audit.boundary_calls == 0 and answers["Q2"] == ["b\n1. p\n2. q"] and row.review == []


def test_lone_marker_out_of_order_is_asked_about(spark):
    row, _ = run(spark, "Q1 a\n4. odd\nQ2 b\nQ4 d", mapping=("Q1", "Q2", "Q4"))
    assert row.audit.boundary_calls == 1


def test_without_adjudication_everything_goes_to_review(spark):
    row, answers = run(spark, "Q1 a\nQ2 b", on=False)
    assert all(a == [] for a in answers.values()) and row.unmapped == [] and [r.text for r in row.review] == ["a", "b"]


def test_offsets_name_the_markers(spark):
    rows = Q._candidates(spark, SF).join(Q.detect(Q.marked_sheets(spark, SF)).select("sheet_id", "normalized"), "sheet_id").collect()
    assert rows and all(r.marker in r.normalized[r.start : r.end] for r in rows)


def test_normalization_drops_tokens(spark):
    text = "<s>a</s> <|im_end|>b\t c<|endoftext|>\r\n\r\n\r\n\r\nd é "
    got = spark.createDataFrame([(text,)], "t string").select(normalize_text(F.col("t"))).first()[0]
    assert got == "a b c\n\nd é"


def test_replies(spark):
    rows = [
        ("not json", False, "ambiguous", None, 0.0, True),
        ('{"decision":"mapped","question_id":"4.","confidence":"high","subject_match":1}', True, "mapped", "Q4", 0.0, True),
        ('{"decision":"mapped","question_id":"Q9","confidence":0.9,"subject_match":true}', True, "mapped", None, 0.9, True),
        ('{"decision":"mapped","question_id":"Q1","confidence":0.9,"subject_match":false}', True, "ambiguous", "Q1", 0.9, True),
        ('{"decision":"mapped","question_id":"1","confidence":7,"subject_match":true,"requires_human_review":"maybe"}', True, "mapped", "Q1", 1.0, False),
        # the rest of a reply counts: what follows the first value makes it no JSON
        ('{"note":"a"} then {"decision":"unmapped","confidence":0.9}', True, "unmapped", None, 0.9, False),
        ('{"decision":"unmapped","confidence":0.9}}', True, "unmapped", None, 0.9, False),
        ('{"decision":"mapped","question_id":"Q1","confidence":0.9,"of":{"page":1}} as asked', False, "ambiguous", None, 0.0, True),
        ('1], [{"decision":"unmapped"}', True, "unmapped", None, 0.0, False),
        # a null in the reply is no default
        ('{"decision":null,"confidence":0.9}', True, "ambiguous", None, 0.9, True),
        ('{"decision":"unmapped","confidence":null}', True, "unmapped", None, 0.0, True),
        ('[{"decision":"unmapped","confidence":{"value":1}}', False, "ambiguous", None, 0.0, True),
        ("", False, "ambiguous", None, 0.0, True),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "reply string")
    got = D.validate(D.parse_replies(df), ["Q1", "Q4"], "mapping").collect()
    assert [(r.reply, r.parsed, r.decision, r.question_id, r.confidence, r.requires_human_review) for r in got] == rows


def test_papers(spark):
    df = spark.createDataFrame([("a", "## Q1. What? [5 Marks]\nbody\n### part\n## Q2 Why [3]\n"), ("b", "intro\nQ1. one thing\nmore [10 Marks]\nQ2) two [5]")], "path string, text string")
    assert [(r.question_id, r.question_text, r.max_marks, r.model_answer) for r in parse_model_answers(df).filter("path = 'a'").orderBy("ord").collect()] == [("Q1", "What?", 5, "body\n### part"), ("Q2", "Why", 3, "")]
    assert [(r.question_id, r.question_text, r.max_marks) for r in parse_question_paper(df).filter("path = 'b'").orderBy("ord").collect()] == [("Q1", "one thing more", 10), ("Q2", "two", 5)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Q1 Apple\nQ2 Pear\nQ3 Fig", {"Q1": "Apple", "Q2": "Pear", "Q3": "Fig"}),
        ("Q1 Explain trees. They grow.\nQ2 ok", {"Q1": "They grow.", "Q2": "ok"}),
        ("Q1\nExplain trees. They grow.", {"Q1": "Explain trees. They grow."}),
        ("Q1 a\nQ1 b", {"Q1": "a b"}),
        ("no marker  here", {"UNKNOWN": "no marker here"}),
        ("", {"UNKNOWN": "Entire OCR Text"}),
        ("Q l one\nQI two\nQ. three\nQ-\tfour", {"Q1": "one", "Q2": "two", "Q3": "three", "Q4": "four"}),
    ],
)
def test_legacy_segmenter(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(once(normalize_text(F.col("t"))).alias("t")).select(segment(F.col("t")).alias("s")).first().s
    assert {x.question: x.answer for x in got} == want


def test_scan(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes(b"x\r\ny")
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "c.txt").write_bytes(b" \n")
    (tmp_path / "d.md").write_bytes(b"no")
    (tmp_path / "50% done+é.v2.txt").write_bytes(b"z")
    sheets, errors = scan_sheets(spark, str(tmp_path))
    assert sorted(tuple(r)[:2] for r in sheets.collect()) == [("50% done+é.v2", "z"), ("a", "x\ny")] and errors.count() == 1


def test_preambles_in_linear_time_say_the_same(spark):
    """The bounds of a document against the predicate on every text before a position."""
    rng = random.Random(3)
    words = ["page", "Page", "12", "fig", "3.2", "continued", "on", "next", "title", "x" * 30, "\n", "\n\n", " ", "\u2003", "\x0b", ".", ":"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", "", "\n"]) for _ in range(rng.randrange(1, 14)))
        rows += [(i, text, start) for start in range(len(text) + 1)]
    rows += [(99, "page 3\n" + "y " * 60, k) for k in range(0, 120, 7)] + [(98, "z" * 79 + "   q", k) for k in range(76, 84)]
    df = spark.createDataFrame(rows, "i int, t string, start int")
    ws = df.withColumn("b", once(preamble_bounds(F.col("t")))).withColumn("p", once(Q_strip(F.substr("t", F.lit(1), F.col("start")))))
    got = ws.select("t", "start", preamble_is_meaningful(F.col("t"), F.col("b"), F.col("start")).alias("new"), ((F.col("p") != "") & ~preamble_is_header(F.col("p"))).alias("old")).collect()
    assert [(r.t, r.start) for r in got if r.new != r.old] == [] and any(r.new for r in got) and not all(r.new for r in got)


def Q_strip(c):
    from markscribe.functions.text import uni_strip

    return uni_strip(c)


def test_digits_of_all_scripts(spark):
    text = "Q٣ three\n२. two\nQuestion No. 𝟜 four"
    got = spark.createDataFrame([(text,)], "t string").select(F.explode(detect_candidates(F.col("t"))).alias("c")).select("c.number", "c.strength").collect()
    assert [tuple(r) for r in got] == [(3, "strong"), (2, "weak"), (4, "strong")]


def test_model_answers_on_all_line_ends(spark):
    text = "## Q1. What? [٥ Marks]\nbody\x0cmore \x0c## Q2 Why\r\nb\x0b### part\x85## q.3) Third [7]"
    rows = parse_model_answers(spark.createDataFrame([("a", text)], "path string, text string"))
    assert [(r.question_id, r.question_text, r.max_marks, r.model_answer) for r in rows.orderBy("ord").collect()] == [("Q1", "What?", 5, "body\nmore"), ("Q2", "Why", None, "b\n### part"), ("Q3", "Third", 7, "")]
    assert load_model_answers(rows).first().answers == {"Q1": "body\nmore", "Q2": "b\n### part", "Q3": ""}


def test_paper_headings_cross_lines(spark):
    text = "# Paper\n## Q1\n\nWhat is a tree? (5 marks)\n#\nQuestion No. 2: Why [3]\r\n## Q2 Why not 4 M"
    rows = parse_question_paper(spark.createDataFrame([("a", text), ("b", "## Q1\n")], "path string, text string"))
    assert [(r.path, r.question_id, r.question_text, r.max_marks) for r in rows.orderBy("path", "ord").collect()] == [("a", "Q1", "What is a tree?", 5), ("a", "Q2", "Why not", 4)]


def test_question_lines(spark):
    cases = [
        ("Q1 Explain trees. They grow.", "Q1", "They grow."),
        ("  question no 12 why? ok", "Q12", "ok"),
        ("Q12) why? ok", "Q12", ") why? ok"),
        ("3. plain", "Q3", "plain"),
        ("Q l one", "Q1", "one"),
        ("Q. dotted", "Q", "dotted"),
        ("no marker", None, ""),
        ("", None, ""),
        (None, None, ""),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, line string")
    got = df.select("i", PatternDetector().detect(F.col("line")).alias("q"), is_question_line(F.col("line")).alias("is")).orderBy("i").collect()
    assert [(r.q.question, r.q.rest, r["is"]) for r in got] == [(q, rest, q is not None) for _, q, rest in cases]
    labels = {"I": "Q1", " l ": "Q1", "QI": "Q1", "7": "Q7", "q3.": "Q3", "": "", "x-1": "X1"}
    out = spark.createDataFrame([(k,) for k in labels], "v string").select("v", normalize_label(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in out} == labels


class Scripted:
    """Answers by what the prompt holds; its first reply to a mapping prompt cannot be parsed."""

    def __init__(self, log):
        self.log = log

    def __call__(self, prompt, new_tokens):
        with open(self.log, "a") as f:
            f.write(json.dumps([prompt, new_tokens]) + "\n")
        if "Does this marker begin" in prompt:
            assert "model answer begins: the fourth" in prompt
            return json.dumps({"decision": "question_boundary", "question_id": "Q4", "confidence": 0.9, "requires_human_review": False})
        if "broken" in prompt:
            raise RuntimeError("no model")
        if new_tokens == 96:
            return "I think so"
        mapped = {"apple": "Q1", "pear": "Q2", "odd": "Q4"}
        return json.dumps({"decision": "mapped", "question_id": next((q for w, q in mapped.items() if w in prompt.split("Questions:")[0]), None), "confidence": 0.95, "subject_match": True})


def test_adjudicator_in_the_fold(spark, tmp_path):
    questions = [Question(1, "one"), Question(2, "two"), Question(4, "four", None, "the fourth " + "x" * 300)]
    text = "Q1 apple\n4. odd\nQ2 pear"
    sheets = spark.createDataFrame([(1, text), (2, text), (3, "Q1 broken\nQ2 pear"), (4, "")], "sheet_id long, raw_text string")
    config = EngineConfig(adjudicate=True)
    rows = {r.sheet_id: r for r in structure_with(sheets, questions, config, Scripted(str(tmp_path / "log"))).collect()}
    answers = {q.question_id: q.answers for q in rows[1].questions}
    assert answers == {"Q1": ["apple"], "Q2": ["pear"], "Q4": ["odd"]} and rows[1].questions == rows[2].questions
    assert (rows[1].audit.calls, rows[1].audit.boundary_calls, rows[1].audit.mapping_calls) == (4, 1, 3)
    assert {q.question_id: q.answers for q in rows[3].questions} == {"Q1": [], "Q2": ["pear"], "Q4": []} and rows[3].unmapped == ["broken"]
    assert rows[4].audit.calls == 0
    asked = [json.loads(x) for x in (tmp_path / "log").read_text().splitlines()]
    firsts = [p for p, n in asked if n in (64, 96)]
    assert len(firsts) == len(set(firsts)) == 6  # equal prompts of two sheets are put once; an unparsable reply is asked for again
    assert sum(n == 192 for _, n in asked) == 4
    third = next(p for p, n in asked if n == 96 and "Part:\npear" in p and "Mapped before: Q1, Q4" in p)
    assert "Not mapped yet: Q2" in third
    plain = adjudicate(sheets, questions, EngineConfig(adjudicate=True, memo=False), Scripted(str(tmp_path / "log2"))).decisions.collect()
    assert len(plain) == 10 and len([1 for x in (tmp_path / "log2").read_text().splitlines() if json.loads(x)[1] in (64, 96)]) == 10


def test_parsable_replies():
    assert is_reply('```json\n{"a": 1}\n```') and is_reply('so {"decision": "mapped"} there') and is_reply("[1]")
    assert not is_reply("no") and not is_reply(None) and not is_reply('so {"a": 1} there')


def test_batch_writes_a_file_per_student(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ann é.txt").write_text("Q1 apple – né\nQ2 pear", encoding="utf-8")
    (tmp_path / "in" / "bad.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "answers.md").write_text("## Q1. One [5 Marks]\nx\n## Q2. Two\ny\n", encoding="utf-8")
    config = EngineConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), logs_dir=str(tmp_path / "logs"), model_answers_path=str(tmp_path / "answers.md"), exam_id="e9", adjudicate=True)
    run_batch(spark, config, Scripted(str(tmp_path / "log")))
    minimal = (tmp_path / "out" / "ann é.json").read_text(encoding="utf-8")
    assert json.loads(minimal) == {"student_id": "ann é", "exam_id": "e9", "answers": [{"question_id": "Q1", "answer": "apple – né"}, {"question_id": "Q2", "answer": "pear"}], "unmapped_content": []}
    assert minimal.endswith("}\n") and '\n    "student_id"' in minimal and "é" in minimal
    debug = json.loads((tmp_path / "out" / "debug" / "ann é_debug.json").read_text(encoding="utf-8"))
    assert list(debug) == ["student", "questions", "review", "unmapped", "audit", "processed_text", "normalized_text"] and debug["questions"]["Q2"] == "pear"
    assert {"model", "device", "dtype", "quantization", "duration_ms"} <= set(debug["audit"])
    assert "bad.txt" in (tmp_path / "logs" / "markscribe.log").read_text() and len(configure_log(str(tmp_path / "logs")).handlers) == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["ann é.json", "debug"]
    assert read_questions(spark, str(tmp_path / "missing.md")) == []


def test_stream_of_sheets(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a%20b.TXT").write_bytes(b"Q1 x\r\nQ2 y")
    (tmp_path / "in" / "blank.txt").write_bytes(b" \n")
    (tmp_path / "in" / "bad.txt").write_bytes(b"\xff")
    (tmp_path / "in" / "no.md").write_bytes(b"Q1")
    stream = stream_sheets(spark, str(tmp_path / "in"), THREE)
    query = stream.select("sheet_id", F.size("blocks").alias("n")).writeStream.format("memory").queryName("sheets_out").trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    assert [tuple(r) for r in spark.table("sheets_out").collect()] == [("a%20b", 2)]


def test_configuration_by_environment():
    config = EngineConfig.from_environment({"MARKSCRIBE_ADJUDICATE": "Yes", "MARKSCRIBE_MAX_CALLS": "5", "MARKSCRIBE_TEMPERATURE": "0.5", "MARKSCRIBE_EXAM_ID": "x", "MARKSCRIBE_QUANTIZE": "false"})
    assert (config.adjudicate, config.max_calls, config.temperature, config.exam_id, config.quantize) == (True, 5, 0.5, "x", False)
    assert EngineConfig(adjudicate=True) == EngineConfig.from_environment({}) and not EngineConfig.from_environment({"MARKSCRIBE_ADJUDICATE": "false"}).adjudicate
    assert EngineConfig().quantization == "none" and not EngineConfig().adjudicate


def test_replies_beyond_forty_positions(spark):
    """Every candidate and block of a long sheet has its decision."""
    sheet = "\n".join(f"Q{1 + i % 4} part {i}" for i in range(60))
    df = spark.createDataFrame([(1, sheet)], "sheet_id long, raw_text string")
    decisions = spark.createDataFrame([(1, "mapping", i + 1, "mapped", "Q1", 0.9, False, True) for i in range(60)], MAPPING)
    row = structure_sheets(df, [Question(n) for n in (1, 2, 3, 4)], EngineConfig(adjudicate=True), decisions).first()
    assert len(row.questions[0].answers) == 60 and row.unmapped == []
    assert detect(df).select(F.size("candidates")).first()[0] == 60


def test_oracles(spark):
    """Every query that has SQL, row by row."""
    con = duckdb.connect()
    for t in ("conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    wrong = []
    for name, sql in Q.ORACLES.items():
        want, got = con.sql(sql), entry.queries()[name](spark, SF)
        order = sorted(want.columns)
        rows = lambda data: sorted(repr(r) for r in data)
        quoted = ", ".join(f'"{c}"' for c in order)
        if sorted(got.columns) != order or rows(tuple(r[c] for c in order) for r in got.collect()) != rows(con.sql(f"select {quoted} from want").fetchall()):
            wrong.append(name)
    assert len(Q.ORACLES) >= 40 and wrong == []
