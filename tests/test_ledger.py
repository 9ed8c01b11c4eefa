"""Replies of remote models that are kept across runs."""

import pytest
from pyspark.sql import functions as F

from factloom.operators import ledger
from factloom.operators.answers import ERROR, NO_MATCH
from factloom.operators.filters import OK, parse_filters
from factloom.sources import tables

QUICK = ledger.Retries(tries=3, wait=0.0)


@pytest.fixture
def calls(tmp_path):
    """A folder in which each call leaves a file, and a reader of what was asked."""
    log = tmp_path / "calls"
    log.mkdir()

    def read():
        return sorted(f.read_text() for f in log.iterdir())

    return str(log), read


def client(log, fails=lambda prompt, before: False):
    """Echoes a prompt; ``fails`` sees the prompt and how often it was asked before."""

    def make():
        import os
        import uuid

        def call(prompt):
            name = prompt.encode().hex()
            before = sum(f.startswith(name + "-") for f in os.listdir(log))
            with open(os.path.join(log, f"{name}-{uuid.uuid4().hex}"), "w") as file:
                file.write(prompt)
            if fails(prompt, before):
                raise ConnectionError(prompt)
            return "re " + prompt

        return call

    return make


def asked(spark, *prompts):
    return spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "qid long, prompt string")


def test_each_different_prompt_is_asked_once(spark, table, calls):
    log, read = calls
    rows = asked(spark, "a", "b", "a", None, "", "b", "a")
    done = ledger.ask(rows, "prompt", table, "m1", client(log), QUICK, buckets=2)
    assert done == ledger.Asked(3, 0, 3) and read() == ["", "a", "b"]
    got = ledger.with_replies(rows, "prompt", table, "m1").orderBy("qid")
    assert [r.reply for r in got.collect()] == ["re a", "re b", "re a", None, "re ", "re b", "re a"]
    assert ledger.ask(rows, "prompt", table, "m1", client(log), QUICK) == ledger.Asked(3, 3, 0)
    assert len(read()) == 3


def test_another_model_answers_for_itself(spark, table, calls):
    log, read = calls
    rows = asked(spark, "a")
    ledger.ask(rows, "prompt", table, "m1", client(log), QUICK, buckets=2)
    assert ledger.ask(rows, "prompt", table, "m2", client(log), QUICK) == ledger.Asked(1, 0, 1)
    assert read() == ["a", "a"]
    assert ledger.with_replies(rows, "prompt", table, "m3").first().reply is None


def test_failing_calls_are_tried_again_and_the_rest_goes_on(spark, table, calls):
    log, read = calls
    # "x" fails twice, then answers; "y" never answers.
    flaky = client(log, lambda p, before: p == "y" or (p == "x" and before < 2))
    done = ledger.ask(asked(spark, "x", "y", "z"), "prompt", table, "m", flaky, QUICK, buckets=2)
    assert (done.answered, done.failed) == (2, 1)
    assert read() == ["x"] * 3 + ["y"] * 3 + ["z"]
    # The next run asks what has no reply, nothing else.
    again = ledger.ask(asked(spark, "x", "y", "z"), "prompt", table, "m", client(log), QUICK)
    assert again == ledger.Asked(3, 2, 1) and read().count("y") == 4 and len(read()) == 8


def test_a_killed_run_keeps_its_earlier_rounds(spark, table, calls, monkeypatch):
    log, read = calls
    prompts = [f"p{i}" for i in range(40)]
    append, done = tables.append, []

    def dying(*args):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(append(*args))
        return done[-1]

    monkeypatch.setattr(tables, "append", dying)
    with pytest.raises(KeyboardInterrupt):
        ledger.ask(asked(spark, *prompts), "prompt", table, "m", client(log), QUICK, round_rows=10, buckets=2)
    monkeypatch.undo()
    kept = tables.read_current(spark, table).count()
    assert 0 < kept == sum(done) < 40
    before = len(read())
    rest = ledger.ask(asked(spark, *prompts), "prompt", table, "m", client(log), QUICK, round_rows=10)
    assert rest == ledger.Asked(40, kept, 40 - kept) and len(read()) - before == 40 - kept
    replies = tables.read_current(spark, table)
    assert replies.count() == replies.select("ask_id").distinct().count() == 40


def test_waits_grow_to_a_bound():
    assert ledger.Retries(tries=5, wait=1.0, longest=3.0).waits() == [1.0, 2.0, 3.0, 3.0]
    assert ledger.Retries(tries=1).waits() == []


def test_no_prompts(spark, table, calls):
    log, read = calls
    empty = asked(spark, "a").limit(0)
    assert ledger.ask(empty, "prompt", table, "m", client(log), buckets=2) == ledger.Asked(0, 0, 0)
    assert ledger.with_replies(empty, "prompt", table, "m").count() == 0 and read() == []


def test_generate_and_filters_from_the_ledger(spark, table, tmp_path):
    class Model:
        def generate(self, prompt):
            if prompt == "bad":
                raise ConnectionError(prompt)
            return prompt.upper()

        def extract(self, prompt):
            return '{"hard_keywords": ["k"], "semantic_query": "s"}'

    rows = spark.createDataFrame(
        [(1, OK, "good"), (2, OK, "bad"), (3, NO_MATCH, None)], "qid long, status string, prompt string"
    )
    got, done = ledger.generate_kept(rows, table, "m", Model, retries=QUICK, buckets=2)
    status = {r.qid: (r.status, r.answer) for r in got.collect()}
    assert done.failed == 1 and status[1] == (OK, "GOOD") and status[2][0] == ERROR and status[3][0] == NO_MATCH
    questions = rows.select("qid", F.lit("who?").alias("question"))
    found, done = ledger.request_filters_kept(questions, str(tmp_path / "asks"), "m", Model, buckets=2)
    assert done == ledger.Asked(1, 0, 1)
    assert {(r.status, r.semantic_query) for r in parse_filters(found).collect()} == {(OK, "s")}
