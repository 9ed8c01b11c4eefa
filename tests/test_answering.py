"""Filters, prompts, answers, transcripts."""

import json

import pytest
from pyspark.sql import functions as F

from factloom.operators.answers import contexts, generate, prompts
from factloom.operators.embed import HashingEmbedder, embed
from factloom.operators.filters import extract_filters, parse_filters, request_filters, vocabulary
from factloom.operators.prompts import GREETING, HYBRID, VECTOR_ONLY, AnswerStyle
from factloom.plans.answering import answer_by_vector, answer_hybrid, transcripts, user_questions
from factloom.sources import staging

RANKED = "qid long, doc_key long, similarity double, rank long, document string"


@pytest.fixture
def terms(spark):
    rows = [("Brazil", "Forward"), ("South Korea", "Goalkeeper"), ("Korea", None), ("Côte d'Ivoire", "Forward")]
    return vocabulary(spark.createDataFrame(rows, "team string, position string"), ["team", "position"])


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize(
    "question, keywords, rest",
    [
        ("Find players from Brazil who scored more than 10 goals in 2022", ["Brazil"], "Find players from who scored more than 10 goals in 2022"),
        ("Best FORWARD of (south  korea)?", ["Forward", "Korea", "South Korea"], "Best of"),
        ("Who plays for Côte d'Ivoire?", ["Côte d'Ivoire"], "Who plays for"),
        ("Brazilian players", [], "Brazilian players"),
        ("Brazil!", ["Brazil"], "Brazil!"),
        ("", [], ""),
    ],
)
def test_extract_filters(spark, terms, question, keywords, rest, small, monkeypatch):
    if not small:
        monkeypatch.setattr(staging, "BROADCAST_ROWS", -1)
    asked = spark.createDataFrame([(1, question)], "qid long, question string")
    row = extract_filters(asked, terms).first()
    assert (row.hard_keywords, row.semantic_query) == (keywords, rest)


def test_parse_filters(spark):
    texts = [
        '{"hard_keywords": ["Brazil"], "semantic_query": "goals"}',
        '{"hard_keywords": [], "semantic_query": ""}',
        '{"hard_keywords": ["Brazil"]}',
        '{"semantic_query": "goals"}',
        "no json",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "qid long, response string")
    got = [(r.hard_keywords, r.semantic_query, r.status) for r in parse_filters(df).orderBy("qid").collect()]
    assert got[0] == (["Brazil"], "goals", "ok") and got[1] == ([], "", "ok")
    assert [status for _, _, status in got[2:]] == ["bad_filters"] * 4


def test_remote_extractor(spark):
    class Fake:
        def extract(self, prompt):
            question = prompt.split('Query: "')[1].split('"')[0]
            return json.dumps({"hard_keywords": question.split()[:1], "semantic_query": prompt[:5]})

    asked = spark.createDataFrame([(1, "Brazil goals"), (2, None)], "qid long, question string")
    rows = parse_filters(request_filters(asked, Fake)).orderBy("qid").collect()
    assert (rows[0].hard_keywords, rows[0].semantic_query) == (["Brazil"], "\n    ")
    assert rows[1].status == "bad_filters"


def test_contexts_are_in_rank_order(spark):
    rows = [(1, i, 0.5, rank, f"d{rank}") for i, rank in enumerate([10, 2, 1, 3])]
    row = contexts(spark.createDataFrame(rows, RANKED).repartition(4)).first()
    assert row.context == "d1\n\n---\n\nd2\n\n---\n\nd3\n\n---\n\nd10" and row.matches == 4


def test_prompts_and_status(spark):
    ranked = spark.createDataFrame([(1, 1, 0.5, 1, "text {question}")], RANKED)
    asked = spark.createDataFrame([(1, "q1", "ok"), (2, "q2", "ok"), (3, "q3", "bad_filters")], "qid long, question string, status string")
    style = AnswerStyle("C={context} Q={question}", "none", "broken")
    rows = prompts(asked, contexts(ranked), style).orderBy("qid").collect()
    assert [(r.status, r.matches, r.prompt) for r in rows] == [
        ("ok", 1, "C=text {question} Q=q1"), ("no_match", 0, None), ("bad_filters", 0, None),
    ]


def test_generate(spark):
    class Model:
        def generate(self, prompt):
            if "boom" in prompt:
                raise RuntimeError(prompt)
            return prompt.upper()

    df = spark.createDataFrame(
        [(1, "ok", "hi"), (2, "ok", "boom"), (3, "no_match", None), (4, "bad_filters", None)],
        "qid long, status string, prompt string",
    )
    rows = generate(df, Model, HYBRID).orderBy("qid").collect()
    assert [(r.status, r.answer) for r in rows] == [
        ("ok", "HI"), ("error", HYBRID.error), ("no_match", HYBRID.no_match), ("bad_filters", HYBRID.error),
    ]


@pytest.fixture
def echo():
    class Echo:
        def generate(self, prompt):
            return prompt

    return Echo


@pytest.fixture
def docs(spark):
    texts = ["The player is Ana . Represents team Brazil", "The player is Bo . Represents team Peru", "The player is Cy . Represents team Brazil"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_key long, document string")
    return embed(df, "document", "vector", lambda: HashingEmbedder(64))


def test_answer_hybrid(spark, docs, terms, echo):
    asked = spark.createDataFrame([(1, "The Brazil player"), (2, "The South Korea player")], "qid long, question string")
    got = answer_hybrid(docs, extract_filters(asked, terms), echo, lambda: HashingEmbedder(64)).orderBy("qid").collect()
    assert got[0].matches == 2 and "team Peru" not in got[0].answer
    assert "User Question: The Brazil player\n" in got[0].answer
    assert (got[1].status, got[1].answer) == ("no_match", HYBRID.no_match)


def test_answer_by_vector(spark, docs, echo):
    asked = spark.createDataFrame([(1, "who is Bo")], "qid long, question string")
    row = answer_by_vector(docs, asked, echo, lambda: HashingEmbedder(64), k=1).first()
    assert "DATABASE CONTEXT:\n        The player is Bo . Represents team Peru\n" in row.answer
    none = answer_by_vector(docs.limit(0), asked, echo, lambda: HashingEmbedder(64)).first()
    assert none.answer == VECTOR_ONLY.no_match


def test_prompt_without_a_generator(spark, docs):
    asked = spark.createDataFrame([(1, "who is Bo")], "qid long, question string")
    row = answer_by_vector(docs, asked, None, lambda: HashingEmbedder(64)).first()
    assert "answer" not in row and row.prompt.startswith("\n        You are a sports assistant")


def test_transcripts(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "old"), (1, 4, "user", "b"), (2, 0, "user", "c")]
    asked = user_questions(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert asked.select("qid").distinct().count() == 3
    got = transcripts(asked.withColumn("answer", F.upper("question"))).orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [
        (1, "assistant", GREETING), (1, "user", "a"), (1, "assistant", "A"), (1, "user", "b"), (1, "assistant", "B"),
        (2, "assistant", GREETING), (2, "user", "c"), (2, "assistant", "C"),
    ]
    assert len({(r.conv_id, r.turn) for r in got}) == len(got)


def test_terms_of_any_number_of_words(spark):
    terms = spark.createDataFrame([("United States of America",), ("team",)], "term string")
    asked = spark.createDataFrame([(1, "Who plays for United States of America?")], "qid long, question string")
    row = extract_filters(asked, terms).first()
    assert row.hard_keywords == ["United States of America"] and row.semantic_query == "Who plays for"


def test_a_null_keyword_is_a_bad_filter(spark):
    got = parse_filters(spark.createDataFrame([('{"hard_keywords": ["t", null], "semantic_query": "x"}',)], "response string"))
    assert got.first().status == "bad_filters"


def test_a_failing_request_costs_one_question(spark):
    class Failing:
        def extract(self, prompt):
            if "boom" in prompt:
                raise RuntimeError("boom")
            return '{"hard_keywords": [], "semantic_query": "x"}'

    asked = spark.createDataFrame([(1, "fine"), (2, "boom")], "qid long, question string")
    got = parse_filters(request_filters(asked, Failing)).orderBy("qid").collect()
    assert [r.status for r in got] == ["ok", "bad_filters"]
