"""Removal of passages that repeat across documents, by level-wise doubling.

The first level looks at windows of half the length. Not all of them are needed:
of the half windows inside a full window the one with the smallest hash stands for
it, so equal full windows are always represented by equal halves, and one in a
dozen positions is looked at. Halves that occur in one document alone are dropped;
so are all windows they stand for. The survivors are extended to twice the length,
as stretches: the run of full windows that one half stands for, taken whole. A
stretch that is equal to one in a smaller document is covered. Only where a half
survives with several different stretches are these taken apart into their single
windows. Longer windows are unions of these and change no verdict, so the levels
end there; ``longest_repeats`` goes on doubling until no candidate survives.

Every word covered by a window that also starts in a document with a smaller
doc_id is removed, judged on the input. Windows are told apart by 128 bits of hash.

Defined cases: NULL, empty and shorter texts have no windows. A row without doc_id
neither loses words nor takes any from others. Rows with one doc_id are one
document: none of them is smaller than the other. An empty table gives no rows.
Other columns are kept by ``cut_texts`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import (
    Spans,
    column,
    column_bytes,
    forgetful,
    fresh,
    keep_batches_small,
    keyed,
    mix,
    small_batches,
    text_key,
    word_hashes,
)
from factloom.sources.staging import Staged, stage

SECOND = np.uint64(0xD6E8FEB86659FD93)


def stretches(hashes: np.ndarray, length: int) -> tuple[np.ndarray, ...] | None:
    """Of each run of full windows that share their half: its hash, the hash of the
    whole stretch, the first window, and the number of windows."""
    n = len(hashes)
    if n < length:
        return None
    half = (length + 1) // 2
    spans = Spans(hashes)
    halves = spans.windows(half)
    choices = np.lib.stride_tricks.sliding_window_view(halves, length - half + 1)
    at = choices.argmin(axis=1) + np.arange(len(choices))  # the first of equal ones
    turns = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate([[0], turns])
    count = np.diff(np.concatenate([first, [len(at)]]))
    return halves[at[first]], spans.of(first, first + count - 1 + length), first, count


def _first_level(docs: DataFrame, length: int) -> DataFrame:
    """(doc, k, half, whole, first, n) of every stretch."""

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = column(batch, "doc_id").to_pylist(), column(batch, "k").to_pylist()
            held, size = [], 0
            for doc, k, text in zip(ids, keys, column_bytes(batch, "text")):
                found = stretches(word_hashes(text.split()), length) if text and doc is not None else None
                if found is not None:
                    held.append((doc, k, *found))
                    size += len(found[0])
                if size >= 1 << 16:
                    yield _joined(held)
                    held, size = [], 0
            if held:
                yield _joined(held)

    return keyed(docs).mapInArrow(run, "doc long, k long, half long, whole long, first int, n int")


def _joined(held: list[tuple]) -> pa.RecordBatch:
    counts = [len(row[2]) for row in held]
    flat = lambda i: np.concatenate([row[i] for row in held])
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.array([row[0] for row in held], np.int64), counts)),
        pa.array(np.repeat(np.array([row[1] for row in held], np.int64), counts)),
        pa.array(flat(2).view(np.int64)), pa.array(flat(3).view(np.int64)),
        pa.array(flat(4).astype(np.int32)), pa.array(flat(5).astype(np.int32)),
    ], names=["doc", "k", "half", "whole", "first", "n"])


def repeats(docs: DataFrame, length: int = 50) -> Staged:
    """(doc, k, starts, ends): per text, the word ranges that repeat a smaller document."""
    with small_batches(docs.sparkSession):
        level = stage(_first_level(docs, length), "stretches").df
    # Level one: halves that occur in several documents.
    halves = level.groupBy("half").agg(
        F.min("doc").alias("_lo"), F.max("doc").alias("_hi"), (F.min("whole") < F.max("whole")).alias("several"))
    halves = stage(halves.where("_lo < _hi").select("half", "several"), "halves")
    level = stage(level.join(halves.side(), "half"), "survivors").df
    # Level two: whole stretches.
    wholes = stage(level.groupBy("half", "whole").agg(F.min("doc").alias("least")), "wholes")
    judged = level.join(wholes.side(), ["half", "whole"])
    covered = judged.where("least < doc").select(
        "doc", "k", F.col("first").alias("start"), (F.col("first") + F.col("n") - 1 + length).alias("end"))
    # Where stretches differ around one half, their single windows, in the smallest document that has the stretch.
    places = judged.where("several AND least = doc").groupBy("doc", "k").agg(F.collect_list(F.struct("first", "n")).alias("_places"))
    places = stage(places.select("doc", "k", F.col("_places.first").alias("firsts"), F.col("_places.n").alias("counts")), "places")
    with small_batches(docs.sparkSession):
        single = stage(_windows(docs, places, length), "windows").df
    owners = single.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("_hi")).where("least < _hi")
    owners = stage(owners.drop("_hi"), "window-owners")
    again = single.join(owners.side(), ["w1", "w2"]).where("least < doc").select(
        "doc", "k", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    ranges = covered.unionByName(again).groupBy("doc", "k").agg(F.collect_list(F.struct("start", "end")).alias("_r"))
    merged = ranges.select("doc", "k", F.col("_r.start").alias("starts"), F.col("_r.end").alias("ends")).mapInArrow(
        _merge_ranges, "doc long, k long, starts array<int>, ends array<int>")
    return stage(merged, "repeats")


def _windows(docs: DataFrame, places: Staged, length: int) -> DataFrame:
    """(w1, w2, doc, k, at) of the single windows in the given stretches."""
    chosen = keyed(docs).withColumnRenamed("doc_id", "doc").join(places.side(), ["doc", "k"]).dropDuplicates(["doc", "k"])

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(column(batch, "doc").to_pylist(), column(batch, "k").to_pylist(), column_bytes(batch, "text"),
                       column(batch, "firsts"), column(batch, "counts"))
            for doc, k, text, firsts, counts in rows:
                firsts, counts = firsts.values.to_numpy(), counts.values.to_numpy()
                ends = np.cumsum(counts)
                at = np.repeat(firsts - (ends - counts), counts) + np.arange(ends[-1])
                hashes = word_hashes(text.split())
                w1 = Spans(hashes).windows(length)[at]
                w2 = Spans(mix(hashes ^ SECOND)).windows(length)[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)),
                    pa.array(np.full(len(at), doc, np.int64)), pa.array(np.full(len(at), k, np.int64)),
                    pa.array(at.astype(np.int32)),
                ], names=["w1", "w2", "doc", "k", "at"])

    return chosen.select("doc", "k", "text", "firsts", "counts").mapInArrow(run, "w1 long, w2 long, doc long, k long, at int")


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = [], []
        for s, e in zip(column(batch, "starts"), column(batch, "ends")):
            s, e = s.values.to_numpy(), e.values.to_numpy()
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            fresh = np.concatenate([[True], s[1:] > e[:-1]])
            starts.append(s[fresh])
            ends.append(e[np.concatenate([fresh[1:], [True]])])
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc"), column(batch, "k"), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            names=["doc", "k", "starts", "ends"])


def kept_words(text: bytes | None, starts: list | None, ends: list | None) -> tuple[list[bytes], int]:
    """The words outside the ranges, and how many were inside."""
    words = text.split() if text else []
    if not starts:
        return words, 0
    out, at = [], 0
    for start, end in zip(starts, ends):
        out += words[at:start]
        at = end
    out += words[at:]
    return out, len(words) - len(out)


def digests(docs: DataFrame, found: Staged) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed ranges of every row."""
    marks = found.side(found.df.select(F.col("doc").alias("_doc"), F.col("k").alias("_k"), "starts", "ends"))
    joined = keyed(docs).join(marks, F.expr("doc_id = _doc AND k = _k"), "left").select("doc_id", "text", "starts", "ends")

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, sums = [], [], []
            for text, starts, ends in zip(column_bytes(batch, "text"), column(batch, "starts").to_pylist(), column(batch, "ends").to_pylist()):
                kept, removed = kept_words(text, starts, ends)
                total.append(len(kept) + removed)
                gone.append(removed)
                sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums),
                 column(batch, "starts"), column(batch, "ends")],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "starts", "ends"])

    keep_batches_small(docs.sparkSession)
    return joined.mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, starts array<int>, ends array<int>")


def cut_texts(docs: DataFrame, found: Staged) -> DataFrame:
    """The documents with repeated passages taken out, columns as they were.

    A text that loses words becomes the kept words with one space between them, and
    ``n_chars`` follows if there is such a column. A document that loses all is left
    out. All others stay as they are.
    """
    doc, k, key, first, last = fresh(docs, "doc", "k", "key", "starts", "ends")
    marks = found.side(found.df.select(F.col("doc").alias(doc), F.col("k").alias(k), F.col("starts").alias(first), F.col("ends").alias(last)))
    joined = docs.withColumn(key, text_key(F.col("text").cast("string"))).join(
        marks, F.expr(f"CAST(doc_id AS BIGINT) = {doc} AND {key} = {k}"), "left").drop(doc, k, key)
    untouched = joined.where(F.col(first).isNull()).drop(first, last)
    schema = docs.schema

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(column_bytes(batch, "text"), column(batch, first).to_pylist(), column(batch, last).to_pylist())
            texts = [b" ".join(kept_words(text, starts, ends)[0]).decode() for text, starts, ends in rows]
            some = pa.array([bool(text) for text in texts])
            values = {"text": pa.array(texts), "n_chars": pa.array(list(map(len, texts)))}
            arrays = [values[f.name].cast(column(batch, f.name).type) if f.name in values else column(batch, f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names).filter(some)

    keep_batches_small(docs.sparkSession)
    cut = joined.where(F.col(first).isNotNull()).mapInArrow(run, schema)
    return untouched.unionByName(cut)


def longest_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, length): per document, the longest window of ``length`` times a power of
    two that repeats a smaller document. Doubles until no candidate survives; each
    level looks at half as many positions as the one before."""
    best, level = None, length
    while True:
        found = repeats(docs, level)
        here = found.df.select(F.col("doc").alias("doc_id"), F.lit(level).alias("length")).distinct()
        best = here if best is None else best.unionByName(here)
        longer = found.df.where(F.exists(F.arrays_zip("starts", "ends"), lambda r: r["ends"] - r["starts"] >= 2 * level))
        if not found.rows or longer.isEmpty():
            return best.groupBy("doc_id").agg(F.max("length").alias("length"))
        level *= 2
