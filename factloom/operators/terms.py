"""Terms of a vocabulary in texts, by a prefix tree over words.

A node of the tree is a run of words with which some term begins, named by its hash.
Texts walk it together: a place in a text stays in the walk only while the words from
there lead to a node, so the work on a text follows from what it shares with the
vocabulary and not from the longest term. Every step is one join on the node, to which
the tree is broadcast if it was measured small; a place carries no more words than the
terms below its node still have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.sources.staging import Staged, stage

ALL, LONGEST = "all", "longest"


def prefix_tree(terms: DataFrame) -> Staged:
    """The nodes of ``(term, words)``: ``node``, how many words lie below it at most
    (``reach``), and the ``terms`` that end in it, sorted; several differ in case alone."""
    lowered = F.transform("words", F.lower)
    # The hash of a run is made from that of the run before, so a long term costs as
    # many hashes as it has words.
    node = F.struct(F.lit("").alias("node"), F.array().cast("array<string>").alias("path"))
    walked = F.aggregate(lowered, node, lambda s, w: F.struct(
        _below(s["node"], w).alias("node"), F.concat(s["path"], F.array(_below(s["node"], w))).alias("path")))
    last = F.size("words")
    nodes = terms.where(last > 0).select("term", last.alias("_last"), F.posexplode(walked["path"]).alias("_at", "node"))
    ends = F.col("_at") + 1 == F.col("_last")
    tree = nodes.groupBy("node").agg(
        F.max(F.col("_last") - F.col("_at") - 1).alias("reach"),
        F.sort_array(F.collect_set(F.when(ends, F.col("term")))).alias("terms"),
    )
    return stage(tree, "term-tree")


def find_terms(texts: DataFrame, tree: Staged, overlaps: str = ALL) -> DataFrame:
    """``(qid, terms, covered)`` of ``(qid, words)`` for each text with a term: the
    terms in it, sorted, and the places of their words. Of terms that share words all
    are found, or only the leftmost and there the ``longest``."""
    if overlaps not in (ALL, LONGEST):
        raise ValueError(f"unknown precedence {overlaps!r}")
    nodes = tree.side(tree.df.select("node", "reach", "terms"))
    first = texts.select("qid", F.posexplode("words").alias("start", "_word"))
    first = first.select("qid", "start", _below(F.lit(""), F.lower("_word")).alias("node"))
    begun = first.join(nodes, "node").select("qid", F.struct("start", "node", "reach", "terms").alias("p"))
    begun = begun.groupBy("qid").agg(F.collect_list("p").alias("_begun"))
    # From here on each place has its own words, no more than its node reaches.
    places = texts.join(begun, "qid").select("qid", "words", F.explode("_begun").alias("p"))
    rest = F.slice(F.col("words"), F.col("p.start") + 2, F.col("p.reach"))
    places = places.select("qid", "p.start", F.lit(1).alias("size"), "p.node", "p.terms", rest.alias("rest"))
    steps = [stage(places, "places").df]
    while True:
        before = steps[-1].where(F.size("rest") > 0)
        onward = before.select(
            "qid", "start", (F.col("size") + 1).alias("size"),
            _below(F.col("node"), F.lower(F.col("rest")[0])).alias("node"), F.slice("rest", 2, F.size("rest")).alias("_rest"))
        reached = onward.join(nodes, "node").select(
            "qid", "start", "size", "node", "terms", F.slice("_rest", F.lit(1), F.col("reach")).alias("rest"))
        step = stage(reached, "places")
        if not step.rows:
            break
        steps.append(step.df)
    ended = [s.where(F.size("terms") > 0).select("qid", F.struct("start", "size", "terms").alias("h")) for s in steps]
    hits = reduce(DataFrame.unionByName, ended).groupBy("qid").agg(F.collect_list("h").alias("hits"))
    if overlaps == LONGEST:
        hits = hits.withColumn("hits", _leftmost_longest(F.col("hits")))
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1)))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["terms"]))))
    return hits.select("qid", found.alias("terms"), F.array_distinct(covered).alias("covered"))


def _below(node: Column, word: Column) -> Column:
    """The node that a word leads to: 128 bits, words hold no blanks."""
    return F.md5(F.concat_ws(" ", node, word))


def _leftmost_longest(hits: Column) -> Column:
    """Of hits that share words the leftmost, of those the longest."""
    ordered = F.array_sort(hits, lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["size"] - a["size"]))
    kind = "array<struct<start:int,size:int,terms:array<string>>>"
    none = F.struct(F.lit(0).alias("end"), F.array().cast(kind).alias("kept"))
    taken = F.aggregate(ordered, none, lambda s, h: F.when(h["start"] < s["end"], s).otherwise(F.struct(
        (h["start"] + h["size"]).alias("end"), F.concat(s["kept"], F.array(h)).alias("kept"))))
    return taken["kept"]
