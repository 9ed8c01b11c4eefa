"""Terms of a vocabulary in texts, against a plain search of every run of words."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import terms as T
from factloom.operators.filters import extract_filters
from factloom.sources import staging


def plain_hits(words, vocabulary):
    """(start, size, terms) of each run of words that is a term."""
    lowered = [w.lower() for w in words]
    by_run = {}
    for term in vocabulary:
        by_run.setdefault(tuple(term.lower().split(" ")), set()).add(term)
    sizes = {len(run) for run in by_run}
    runs = [(i, n) for n in sizes for i in range(len(words) - n + 1)]
    return [(i, n, by_run[tuple(lowered[i : i + n])]) for i, n in runs if tuple(lowered[i : i + n]) in by_run]


def plain_find(words, vocabulary, overlaps):
    hits, end, kept = plain_hits(words, vocabulary), 0, []
    if overlaps == T.LONGEST:
        for hit in sorted(hits, key=lambda h: (h[0], -h[1])):
            if hit[0] >= end:
                kept.append(hit)
                end = hit[0] + hit[1]
        hits = kept
    found = sorted({t for _, _, terms in hits for t in terms})
    covered = {p for start, size, _ in hits for p in range(start, start + size)}
    return found, covered


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("overlaps", [T.ALL, T.LONGEST])
def test_like_a_plain_search(spark, small, overlaps, monkeypatch):
    if not small:
        monkeypatch.setattr(staging, "BROADCAST_ROWS", -1)
    rng = random.Random(7)
    letters = ["a", "b", "C", "é", "İ", "ß"]
    draw = lambda n: [rng.choice(letters) for _ in range(n)]
    vocabulary = sorted({" ".join(draw(rng.randint(1, 5))) for _ in range(40)} | {"a b", "A b", " ".join(["a"] * 8)})
    texts = [draw(rng.randint(0, 25)) for _ in range(60)] + [["a"] * 20, ["zz"] * 5, []]
    asked = spark.createDataFrame([(i, w) for i, w in enumerate(texts)], "qid long, words array<string>")
    known = spark.createDataFrame([(t, t.split(" ")) for t in vocabulary], "term string, words array<string>")
    got = {r.qid: (r.terms, set(r.covered)) for r in T.find_terms(asked, T.prefix_tree(known), overlaps).collect()}
    expected = {i: plain_find(w, vocabulary, overlaps) for i, w in enumerate(texts)}
    assert got == {i: found for i, found in expected.items() if found[0]}


def test_a_long_term_adds_no_places(spark, monkeypatch):
    """What is walked follows from shared words, whatever the longest term has."""
    rows = []
    kept = T.stage

    def counting(df, label, *more):
        done = kept(df, label, *more)
        rows.append((label, done.rows))
        return done

    monkeypatch.setattr(T, "stage", counting)
    asked = spark.createDataFrame([(1, "the house in the park by the river".split())], "qid long, words array<string>")

    def walked(*vocabulary):
        rows.clear()
        known = spark.createDataFrame([(t, t.split(" ")) for t in vocabulary], "term string, words array<string>")
        found = [r.terms for r in T.find_terms(asked, T.prefix_tree(known)).collect()]
        return found, [n for label, n in rows if label == "places"]

    assert walked("the park", "river") == ([["river", "the park"]], [4, 1, 0])
    long = " ".join(["the", "house", *[f"w{i}" for i in range(300)]])
    assert walked("the park", "river", long) == ([["river", "the park"]], [4, 2, 0])


def test_a_place_carries_no_more_words_than_its_terms(spark):
    known = spark.createDataFrame([("a b c", ["a", "b", "c"]), ("a", ["a"])], "term string, words array<string>")
    tree = T.prefix_tree(known).df.orderBy(F.desc("reach")).collect()
    assert [(r.reach, r.terms) for r in tree] == [(2, ["a"]), (1, []), (0, ["a b c"])]


def test_longest_of_overlapping_terms(spark):
    vocabulary = ["New York", "York City Hall", "New York City", "City"]
    terms = spark.createDataFrame([(t,) for t in vocabulary], "term string")
    asked = spark.createDataFrame([(1, "Is New York City Hall open?"), (2, None), (3, "York")], "qid long, question string")
    every = {r.qid: (r.hard_keywords, r.semantic_query) for r in extract_filters(asked, terms).collect()}
    assert every == {1: (sorted(vocabulary), "Is open"), 2: ([], None), 3: ([], "York")}
    one = {r.qid: (r.hard_keywords, r.semantic_query) for r in extract_filters(asked, terms, overlaps="longest").collect()}
    assert one == {1: (["New York City"], "Is Hall open"), 2: ([], None), 3: ([], "York")}
    with pytest.raises(ValueError):
        extract_filters(asked, terms, overlaps="first").collect()


def test_no_terms_and_no_texts(spark):
    asked = spark.createDataFrame([(1, "who")], "qid long, question string")
    none = spark.createDataFrame([(None,)], "term string")
    assert extract_filters(asked, none).first().hard_keywords == []
    some = spark.createDataFrame([("who",)], "term string")
    assert extract_filters(asked.limit(0), some).collect() == []
