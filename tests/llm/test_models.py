"""Language identification, nearest neighbours and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from factloom.llm import ann, langid
from factloom.llm.queries import QUERIES


def test_languages_of_held_out_documents(sf):
    docs = sf("documents")
    model = langid.train(docs)
    assert 0 < (model.weights != 0).mean() < 0.9  # sparse
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toArrow().to_pylist()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_on_odd_tables(nasty, nothing):
    model = langid.train(nasty)
    got = langid.predict(nasty, model).toArrow().to_pylist()
    assert len(got) == nasty.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (4, 5, 6, 11))
    assert all(r["lang_pred"] in model.languages for r in got if r["doc_id"] in (1, 7, 9))
    assert langid.predict(nothing, model).count() == 0
    empty = langid.train(nothing)
    assert {r["lang_pred"] for r in langid.predict(nasty, empty).collect()} == {"und"}
    kept = langid.identified(nasty, model, least=0.0)
    assert kept.columns == nasty.columns and {4, 5, 6, 11}.isdisjoint(r["doc_id"] for r in kept.collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, part string").repartition(3)


def plain_nearest(rows, k):
    good = [(i, r[0], np.array(r[1], np.float32).astype(float)) for i, r in enumerate(rows)
            if r[0] is not None and r[1] is not None and None not in r[1] and np.isfinite(np.array(r[1], float)).all() and any(r[1]) and len(r[1]) == 4]
    out = Counter()
    for i, vec_id, x in good:
        if vec_id % 20 == 0:
            best = sorted((-(x * y).sum(), other) for j, other, y in good if j != i)[:k]
            out.update((vec_id, rank, other, round(-s, 12)) for rank, (s, other) in enumerate(best, 1))
    return out


def test_nearest_on_odd_tables(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(1).tolist(), 1, "x") for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 0.5, 0.25], 1, "x") for i in range(70)]  # ties
    rows += [(200, None, 1, "x"), (220, [0.0] * 4, 1, "x"), (240, [1.0, None, 1.0, 1.0], 1, "x"), (260, [1.0, float("nan"), 0.0, 0.0], 1, "x"),
             (280, [float("inf"), 0.0, 0.0, 0.0], None, "x"), (None, [1.0, 1.0, 1.0, 1.0], 1, "x"), (300, [1.0], 1, "x"), (20, rows[20][1], 1, "x")]
    table = vectors(spark, rows)
    found = ann.search(table, F.col("vec_id") % 20 == 0, k=20, router=ann.Router(np.zeros((4, 1)), np.zeros(1), 1))
    got = Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in found.collect())
    assert got == plain_nearest(rows, 20)
    few = vectors(spark, rows[:3])
    assert Counter((r["query_id"], r["vec_id"]) for r in ann.search(few, F.col("vec_id") % 20 == 0).collect()) == Counter([(0, 1), (0, 2)])
    assert ann.search(vectors(spark, rows[:1]), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_of_a_hot_part_give_the_same(spark, monkeypatch):
    rows = [(i, np.random.default_rng(i).normal(size=4).tolist(), 1, "x") for i in range(200)]
    router = ann.Router(np.zeros((4, 1)), np.zeros(1), 1)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    found = ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, router=router)
    got = Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in found.collect())
    assert got == plain_nearest(rows, 20)


def test_a_query_in_a_nearly_empty_part_gets_all_it_asks_for(spark):
    """Vectors are routed by the sign of their first place; one part holds three rows."""
    rows = [(i, [1.0, float(i), 0.5]) for i in range(1, 40)] + [(0, [-1.0, 1.0, 2.0]), (100, [-1.0, 2.0, 2.0]), (101, [-1.0, 3.0, 1.0])]
    router = ann.Router(np.array([[1.0, -1.0], [0, 0], [0, 0]]), np.zeros(2), 1)
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id").isin(0, 5), k=20, router=router).collect()
    for query in (0, 5):
        own = dict(rows)[query]
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != query)[:20]
        got = [(r["rank"], r["vec_id"]) for r in found if r["query_id"] == query]
        if query == 0:
            assert sorted(got) == [(n, i) for n, (_, i) in enumerate(best, 1)]
        assert len(got) == 20



def test_recall_with_learned_partitions(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = ann.search(table, F.col("vec_id") % 20 == 0).cache()
    assert ann.recall(table, found, F.col("vec_id") % 20 == 0) >= 0.9


def test_parts_of_the_sample_are_balanced(spark):
    rows = ann.usable(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    x = ann._matrix(rows.toArrow().column("embedding"))
    part = ann._balanced(x, ann._neighbours(x, 10), 16)
    assert np.bincount(part, minlength=16).max() <= 1.1 * len(x) / 16 + 1


def test_stages_keep_columns_and_clean_documents(nasty, nothing, spark, tmp_path):
    spark.createDataFrame([(1, "a benchmark text about nothing in particular")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for docs in (nasty, nothing):
        for _, step in corpus_pipeline.STAGES[:-1]:
            after = step(spark, docs, str(tmp_path))
            assert after.columns == docs.columns
            docs = after.cache()
        last = corpus_pipeline.pack(spark, docs, str(tmp_path)).toArrow().to_pylist()
        if last:
            assert {r["doc_id"] for r in last} >= {1, 7, 12, 13} and not {2, 4, 5, 6, 10, 11} & {r["doc_id"] for r in last}


def test_near_duplicate_stage_keeps_one_of_each(nasty, spark):
    kept = corpus_pipeline.near_duplicates(spark, nasty, "").collect()
    ids = Counter(r["doc_id"] for r in kept)
    assert ids[1] == 1 and ids[2] == ids[3] == ids[8] == ids[10] == 0 and ids[7] == 1 and ids[4] == 1


def test_everything_is_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
