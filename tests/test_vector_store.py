"""Vectors that are kept across loads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.functions.hashing import with_keys
from factloom.operators import vector_store
from factloom.plans import loads
from factloom.schemas import DOCUMENT, VECTOR
from factloom.sources import tables

SPEC = loads.LoadSpec(keys=("id",), sentence=("Row", "{word}"), buckets=4)


def counting(log):
    """A model that writes each text it is given to a folder."""

    class Model:
        dim, batch_size = 2, 3

        def encode(self, texts):
            import os
            import uuid

            with open(os.path.join(log, uuid.uuid4().hex), "w") as file:
                file.write("\n".join(texts))
            return np.array([[len(t), 1] for t in texts], np.float32)

    return Model


@pytest.fixture
def seen(tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def read():
        texts = sorted(t for f in log.iterdir() for t in f.read_text().split("\n"))
        for f in log.iterdir():
            f.unlink()
        return texts

    return str(log), read


def raw(spark, rows):
    return with_keys(spark.createDataFrame(rows, "id int, word string, other int"), ["id"])


def vectors(spark, table):
    return {r["id"]: (r[DOCUMENT], r[VECTOR], r["other"]) for r in tables.read_current(spark, table).collect()}


def test_only_new_sentences_reach_the_model(spark, tmp_path, seen):
    log, read = seen
    table, store = str(tmp_path / "t"), str(tmp_path / "s")
    refresh = lambda rows, model="m1": loads.refresh_vectors(raw(spark, rows), table, store, model, SPEC, counting(log))
    assert refresh([(1, "a", 0), (2, "b", 0), (3, "a", 0), (4, None, 0)]).embedded == 2
    assert read() == ["Row a", "Row b"]
    # One row as it was, one with another payload, one with a new word, two new rows.
    done = refresh([(1, "a", 0), (2, "b", 9), (3, "ccc", 0), (5, "b", 0), (6, "dd", 0)])
    assert read() == ["Row ccc", "Row dd"]
    assert (done.embedded, done.merged.inserted, done.merged.updated) == (2, 2, 2)
    assert vectors(spark, table) == {
        1: ("Row a", [5, 1], 0), 2: ("Row b", [5, 1], 9), 3: ("Row ccc", [7, 1], 0), 4: (None, None, 0),
        5: ("Row b", [5, 1], 0), 6: ("Row dd", [6, 1], 0)}
    assert refresh([(1, "a", 0)]) == loads.VectorRefresh(0, done.merged.__class__(0, 0, 0, 0))
    assert read() == []


def test_another_model_version_starts_anew(spark, tmp_path, seen):
    log, read = seen
    table, store = str(tmp_path / "t"), str(tmp_path / "s")
    rows = raw(spark, [(1, "a", 0), (2, "b", 0)])
    for model, expected in (("m1", ["Row a", "Row b"]), ("m2", ["Row a", "Row b"]), ("m1", [])):
        done = loads.refresh_vectors(rows, table, store, model, SPEC, counting(log))
        assert read() == expected and done.embedded == len(expected)
    assert done.merged.updated == 2
    assert vector_store.forget(spark, store, ["m2"]) == 2


def test_a_batch_beyond_the_broadcast_limit_finds_the_same(spark, tmp_path, seen, monkeypatch):
    log, read = seen
    store = str(tmp_path / "s")
    texts = spark.range(300).select(F.concat(F.lit("t"), (F.col("id") % 100).cast("string")).alias("text"))
    assert vector_store.refresh(texts.where("id < 40"), "text", store, "m", counting(log), buckets=2) == vector_store.Refreshed(40, 40)
    read()
    monkeypatch.setattr("factloom.sources.staging.BROADCAST_ROWS", 0)
    assert vector_store.refresh(texts, "text", store, "m", counting(log), tasks=2) == vector_store.Refreshed(100, 60)
    assert len(read()) == 60
    joined = vector_store.with_vectors(texts, "text", store, "m", "v")
    assert joined.count() == 300 and joined.where("v IS NULL").count() == 0


def test_no_rows(spark, tmp_path):
    none = raw(spark, []).limit(0)
    assert loads.refresh_vectors(none, str(tmp_path / "t"), str(tmp_path / "s"), "m", SPEC).embedded == 0
    assert tables.read_current(spark, str(tmp_path / "t")).count() == 0
