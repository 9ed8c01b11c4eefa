"""Keyword filters over stored groups, against the filter on every text."""

import pytest
from pyspark.sql import functions as F

from factloom.functions.text import contains_all
from factloom.operators import keyword_index as index

WORDS = ["Brazil", "größe", "ÉTÉ", "İstanbul", "on_e", "50%", "O'Neil", "ab", "日本語", "back\\slash", "😀😀😀x"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "docs")
    rows = [(i, WORDS[i % len(WORDS)], f"text {i} of {WORDS[i % len(WORDS)]} and more") for i in range(220)]
    rows += [(300, "none", None), (301, "none", ""), (302, "Brazil", "brazil"), (302, "Brazil", "brazil")]
    docs = spark.createDataFrame(rows, "doc_key long, team string, document string")
    index.build(docs, path, 12, ["team", "doc_key"])
    return path, docs


@pytest.mark.parametrize(
    "keywords, literal",
    [
        ([], False), (["brazil"], False), (["BRAZIL", "text 11 "], False), (["a"], False), ([""], False),
        (["on_e"], False), (["on_e"], True), (["br%il"], False), (["t%of%zil"], False), (["br%il"], True), (["50%"], True),
        (["O'Neil"], False), (["O'Neil"], True), (["GRÖSSE"], False), (["GRÖßE"], False), (["été"], False),
        (["i̇stanbul"], False), (["日本語"], False), (["本_"], False), (["back\\slash"], False), (["😀😀😀"], False),
        (["nowhere at all"], False), (["brazil", "été"], False),
    ],
)
def test_like_the_filter_on_every_text(spark, stored, keywords, literal):
    path, docs = stored
    got = index.find(spark, path, keywords, literal)
    expected = docs.where(contains_all(F.col("document"), keywords, literal))
    assert got.df.columns == docs.columns
    assert sorted(got.df.collect()) == sorted(expected.collect())
    assert 0 <= got.read <= got.groups


def test_groups_without_the_grams_are_not_read(spark, stored):
    path, _ = stored
    got = index.find(spark, path, ["İstanbul"])
    assert 0 < got.read < got.groups // 2
    # Only the folders of those groups are scanned.
    files = got.df.select(F.input_file_name().alias("f")).distinct().count()
    assert files <= got.read
    assert "PartitionFilters: [doc_group" in got.df._jdf.queryExecution().toString().replace("isnotnull(", "")
    assert index.find(spark, path, ["nowhere at all"]).read == 0
    assert index.find(spark, path, ["a_b%"]).read == got.groups


def test_an_empty_collection(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_key long, document string")
    index.build(docs, str(tmp_path / "docs"), 3, ["doc_key"])
    got = index.find(spark, str(tmp_path / "docs"), ["brazil"])
    assert got.df.collect() == [] and got.df.columns == docs.columns and got.groups == got.read == 0
