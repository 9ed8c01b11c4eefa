"""Sentences, keywords, vectors, embedding."""

import hashlib
import math
import weakref

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.functions import hashing
from factloom.functions.text import contains_keyword, render, sentence
from factloom.functions.vectors import check_dim, cosine, cosine_to, to_json_text, to_vector
from factloom.operators.embed import HashingEmbedder, embed, embed_distinct

PLAYERS = "player_name string, team string, position string, total_goals_tournament long, total_minutes_tournament long"


def test_sentence(spark):
    df = spark.createDataFrame([("Ana", "Brazil", "Forward", 3, 270), ("Bo", "Peru", None, 0, 90)], PLAYERS)
    full, broken = [r.s for r in df.select(sentence().alias("s")).collect()]
    assert full == (
        "The player is Ana . Represents team Brazil . Plays as Forward . "
        "During the tournament scored 3 goals and played 270 minutes."
    )
    assert broken is None
    skipped = df.where("position IS NULL").select(sentence(skip_nulls=True).alias("s")).first().s
    assert "Plays as . During" in skipped


@pytest.mark.parametrize(
    "text, keyword, found, found_literally",
    [
        ("Team NATION_12 won", "nation_1", True, True),
        ("Team NATIONX1 won", "nation_1", True, False),
        ("sure, 100 percent", "1%cent", True, False),
        ("J. O'Brien", "O'Brien", False, True),
        ("J. OBrien", "O'Brien", True, False),
        ("path a\\b", "a\\", True, True),
        ("path a\\b_c", "a\\b_", True, True),
        ("ÉLAN", "élan", True, True),
        ("line one\nline two", "one%two", True, False),
        ("anything", "", True, True),
        (None, "", None, None),
    ],
)
def test_contains_keyword(spark, text, keyword, found, found_literally):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(contains_keyword(F.col("t"), keyword), contains_keyword(F.col("t"), keyword, True)).first()
    assert tuple(row) == (found, found_literally)


def test_render(spark):
    row = spark.range(1).select(render('a {x} "b" {y}{x}', x=F.col("id").cast("string"), y=F.lit("{z}")).alias("s"))
    assert row.first().s == 'a 0 "b" {z}0'


def test_cosine(spark):
    pairs = [([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([1.0, 0.0], [-3.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(pairs, "a array<float>, b array<float>")
    got = [r.c for r in df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got[:3] == pytest.approx([0.0, 1.0, -1.0]) and got[3:] == [None, None]
    other = [r.c for r in df.select(cosine_to(F.col("a"), [3.0, 4.0]).alias("c")).collect()]
    assert other[:3] == pytest.approx([0.6, 7 / 5 / math.sqrt(2), 0.6]) and other[3:] == [None, None]
    assert df.select(cosine_to(F.col("b"), [0.0, 0.0]).alias("c")).where("c IS NOT NULL").count() == 0


def test_check_dim(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "v array<double>")
    checked = df.select(check_dim(F.col("v"), 2).alias("v"))
    assert [r.v for r in checked.collect()] == [[1.0, 2.0], None]
    assert checked.schema["v"].dataType.simpleString() == "array<float>"
    with pytest.raises(Exception, match="must have 3 elements, has 2"):
        df.select(check_dim(F.col("v"), 3)).collect()


def test_vector_json(spark):
    df = spark.createDataFrame([([0.5, -1.25, 3.0],)], "v array<float>")
    text = df.select(to_json_text(F.col("v")).alias("j"))
    assert text.select(to_vector(F.col("j"), 3).alias("v")).first().v == [0.5, -1.25, 3.0]


def test_embedding_is_the_same_however_it_is_batched(spark):
    texts = ["a b  a", "", "Élan\tx\ny A", None, "b"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    model = HashingEmbedder(16)
    expected = {i: None if t is None else model.encode([t])[0].tolist() for i, t in enumerate(texts)}
    for ways in (embed, embed_distinct):
        for size in (1, 7, 1000):
            made = ways(df, "t", "v", lambda size=size: HashingEmbedder(16, size)).collect()
            assert {r.id: r.v for r in made} == expected
    spread = embed_distinct(df, "t", "v", lambda: HashingEmbedder(16), tasks=5)
    assert {r.id: r.v for r in spread.collect()} == expected


def test_distinct_texts_are_embedded_once(spark):
    class Counting(HashingEmbedder):
        def encode(self, texts):
            assert len(set(texts)) == len(texts)
            return super().encode(texts)

    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(300)], "id int, t string")
    assert embed_distinct(df.coalesce(1), "t", "v", Counting).where("v IS NULL").count() == 0


def test_embedder_counts_words():
    vectors = HashingEmbedder(8).encode(["one two one", ""])
    assert vectors.shape == (2, 8) and vectors.dtype == np.float32
    assert sorted(vectors[0])[-2:] in ([1, 2], [0, 3]) and not vectors[1].any()


def test_portable_hash_tells_separators_in_texts_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("~", None), (None, "~"), ("a\\", "|b"), ("a\\|", "b"), ("a", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    hashes = [r[0] for r in df.select(hashing.portable_hash([df.x, df.y])).collect()]
    assert len(set(hashes)) == len(rows)
    assert hashes[-1] == hashlib.md5(b"a|b").hexdigest()


def test_columns_of_any_name_are_hashed(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 3, "x")], "`a.b` int, `c``d` int, `e f` string")
    got = hashing.with_keys(df, ["a.b"]).collect()
    assert got[0]["row_sk"] == got[1]["row_sk"] and got[0]["row_hash"] != got[1]["row_hash"]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_vectors_are_made_next_to_their_rows_where_there_are_many(spark, monkeypatch, most):
    """No vector of a text with few rows is stored or joined; each is made once, in small steps."""
    from factloom.operators import embed as module

    class Counting(HashingEmbedder):
        def encode(self, texts):
            assert 0 < len(texts) <= 4 and len(set(texts)) == len(texts)
            return super().encode(texts)

    monkeypatch.setattr(module, "BROADCAST_BYTES", most, raising=False)
    monkeypatch.setattr(module, "TASK_ROWS", 50, raising=False)
    plain_stage, staged = module.stage, {}

    def counting(df, label, *metrics, **options):
        staged[label] = (done := plain_stage(df, label, *metrics, **options)).rows
        return done

    monkeypatch.setattr(module, "stage", counting)
    texts = ["hot", None, *(f"a b{i // 3}" for i in range(120))] + ["hot", None] * 90
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    made = embed_distinct(df, "t", "v", lambda: Counting(16, 4)).collect()
    model = HashingEmbedder(16)
    assert {r.id: r.v for r in made} == {i: None if t is None else model.encode([t])[0].tolist() for i, t in enumerate(texts)}
    assert len(made) == len(texts) and staged.get("vectors") == (41 if most else 1)


def test_a_model_is_given_few_bytes_of_text_at_once(spark):
    class Frugal(HashingEmbedder):
        def encode(self, texts):
            assert len(texts) == 1 or sum(map(len, texts)) <= 4 << 20
            return super().encode(texts)

    df = spark.range(0, 90, 1, 1).select("id", F.when(F.col("id") % 9 > 0, F.concat(F.lit("a "), F.repeat(F.lit("x"), F.when(F.col("id") == 5, 5_000_000).otherwise(400_000)))).alias("t"))
    got = embed(df, "t", "v", lambda: Frugal(8)).select("id", F.col("v").isNull().alias("none"), F.aggregate("v", F.lit(0.0), lambda s, x: s + x).alias("words")).collect()
    assert {r.id: (r.none, r.words) for r in got} == {i: (i % 9 == 0, 2.0 if i % 9 else None) for i in range(90)}


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_a_task_holds_few_vectors_however_many_rows_it_has(spark, monkeypatch, most):
    """What a model has made is let go before it makes much more, next to the rows and before a join."""
    from factloom.operators import embed as module

    class Tracked(HashingEmbedder):
        def encode(self, texts):
            self.made = [seen for seen in getattr(self, "made", []) if seen() is not None]
            assert len(self.made) <= 4, "vectors of earlier calls are still held"
            values = super().encode(texts)
            self.made.append(weakref.ref(values))
            return values

    monkeypatch.setattr(module, "BROADCAST_BYTES", most, raising=False)
    df = spark.range(0, 2000, 1, 1).select("id", F.concat(F.lit("a b"), F.col("id")).alias("t"))
    for ways in (embed, embed_distinct):
        made = ways(df, "t", "v", lambda: Tracked(16, 10)).coalesce(1).select("id", F.aggregate("v", F.lit(0.0), lambda s, x: s + x))
        assert sorted(map(tuple, made.collect())) == [(i, 2.0) for i in range(2000)]


def test_a_model_remembers_few_words_however_many_texts_it_reads():
    model = HashingEmbedder(16)
    for first in range(0, 400_000, 10_000):
        counts = model.encode([" ".join(f"w{i}" for i in range(first, first + 10_000))])
        assert counts.sum() == 10_000 and len(model._known) <= 200_000 + 10_001
