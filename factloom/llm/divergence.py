"""Audit of how far the sources of a language differ in the words they use.

Single-pass in-memory indexing. Each task reads its documents once and counts terms
in memory, per (lang, source) and, for documents, per lang. Once ``BLOCK_ENTRIES``
postings are held, they leave as a term-sorted run, cut by hash shard of the term,
and memory starts anew. The runs lie in shared storage. Per shard and language the
runs are merged by a heap, term by term, into frequencies; terms in fewer than
``min_docs`` documents of the language end there.

Smoothed shares of terms, in billionths: p = 1 + floor(10**9 (n + 2) / (N + 2V)).
What two sources differ by is summed over all kept terms, but most terms are missing
in most sources. So each pair starts from V times the difference of two absent terms,
and only terms that occur in one of both are streamed past as corrections. A language's
terms are dealt to as many groups as their number asks for; the sums of the groups
are added up. All arithmetic is on whole numbers.

Shuffled are the runs (a term once per block and source), the frequencies of kept
terms, and sums. The number of shards follows the volume of text, so what one task
merges does not grow with the table; that volume is summed beforehand.

Defined cases: NULL in text, lang or source is an empty string; a group without terms
takes part with zero counts. Repeated rows and ids count each time. Very long texts
are read in slices. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.texts import column, column_bytes, small_batches
from factloom.sources.staging import Staged, stage

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
BLOCK_ENTRIES = 600_000
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 64
SLICE = 1 << 20
GROUP_POSTINGS = 250_000
SOURCES = 256

# Letters of ASCII in lower case and all bytes from 128 on stay; the rest parts terms.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_RUNS = pa.schema([
    ("shard", pa.int32()), ("lang", pa.string()), ("run", pa.int64()), ("sources", pa.list_(pa.string())),
    ("terms", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("source", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())),
])
_RUNS_SQL = ("shard int, lang string, run long, sources array<string>, terms array<binary>, docs array<long>, "
             "sizes array<int>, source array<int>, n array<long>")


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """A text with blanks between its terms, in slices that part no term."""
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


class Block:
    """Postings in memory: occurrences per (lang, source), documents per lang."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes | None) -> None:
        counts, docs = self.counts[lang, source], self.docs[lang]
        before = len(counts) + len(docs)
        seen = set()
        for part in slices((text or b"").translate(_LETTERS)):
            words = part.split()
            counts.update(words)
            seen.update(words)
        docs.update(seen)
        self.entries += len(counts) + len(docs) - before

    def run(self, number: int, shards: int) -> Iterator[pa.RecordBatch]:
        """The block as a run: per language and shard, its terms in order with their postings."""
        for lang, docs in self.docs.items():
            sources = sorted(source for own, source in self.counts if own == lang)
            yield pa.RecordBatch.from_pylist(
                [{"shard": -1, "lang": lang, "run": number, "sources": sources}], schema=_RUNS)
            terms = sorted(docs)
            if not terms:
                continue
            place = dict(zip(terms, count()))
            shard = np.fromiter((zlib.crc32(term) % shards for term in terms), np.int64, len(terms))
            seen = np.fromiter(map(docs.__getitem__, terms), np.int64, len(terms))
            at, source, n = [], [], []
            for i, name in enumerate(sources):
                own = self.counts[lang, name]
                at.append(np.fromiter(map(place.__getitem__, own), np.int64, len(own)))
                source.append(np.full(len(own), i, np.int32))
                n.append(np.fromiter(own.values(), np.int64, len(own)))
            at, source, n = np.concatenate(at), np.concatenate(source), np.concatenate(n)
            order = np.argsort(shard, kind="stable")  # terms stay sorted within a shard
            new = np.empty(len(terms), np.int64)
            new[order] = np.arange(len(terms))
            at = new[at]
            by_term = np.argsort(at, kind="stable")
            sizes = np.bincount(at, minlength=len(terms))
            source, n, seen = source[by_term], n[by_term], seen[order]
            terms = pa.array(terms, pa.binary()).take(pa.array(order))
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            posting = np.concatenate([[0], np.cumsum(sizes)])
            rows, held = [], 0
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = int(cuts[k]), int(cuts[k + 1])
                x, y = int(posting[a]), int(posting[b])
                rows.append({"shard": k, "lang": lang, "run": number, "sources": sources, "terms": terms[a:b].to_pylist(),
                             "docs": seen[a:b], "sizes": sizes[a:b].astype(np.int32), "source": source[x:y], "n": n[x:y]})
                held += y - x
                if held >= 1 << 16:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)


def runs(docs: DataFrame, shards: int, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Term-sorted runs of all documents, cut by shard; shard -1 names the sources that occur."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = Block(), TaskContext.get().partitionId() << 24
        for batch in batches:
            names = zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist())
            for (lang, source), text in zip(names, column_bytes(batch, "text")):
                block.add(lang, source, text)
                if block.entries >= block_entries:
                    yield from block.run(number, shards)
                    block, number = Block(), number + 1
        yield from block.run(number, shards)

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(*text).mapInArrow(build, _RUNS_SQL)


def merge_runs(blocks: pa.Table, min_docs: int) -> tuple[list[bytes], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Heap-merge of the runs of one shard and language. Returns the kept terms, the
    sources, and per posting its term, its source and its number of occurrences."""
    terms = [x.as_py() for x in blocks.column("terms")]
    docs = [x.values.to_numpy() for x in blocks.column("docs")]
    sizes = [x.values.to_numpy() for x in blocks.column("sizes")]
    names = [x.as_py() for x in blocks.column("sources")]
    sources = sorted(set().union(*names))
    number = dict(zip(sources, count()))
    kept, where = [], [([], []) for _ in terms]  # per run: new and old places of its kept terms
    merged = heapq.merge(*(zip(own, repeat(b), count()) for b, own in enumerate(terms)))
    for term, places in groupby(merged, key=itemgetter(0)):
        places = list(places)
        if sum(docs[b][i] for _, b, i in places) >= min_docs:
            for _, b, i in places:
                where[b][0].append(len(kept))
                where[b][1].append(i)
            kept.append(term)
    keys, values = [], []
    for b, (new, old) in enumerate(where):
        if not new:
            continue
        lengths = sizes[b][old].astype(np.int64)
        firsts = (np.cumsum(sizes[b], dtype=np.int64) - sizes[b])[old]
        at = np.repeat(firsts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        here = np.array([number[name] for name in names[b]], np.int64)
        keys.append(np.repeat(np.array(new, np.int64), lengths) * len(sources)
                    + here[blocks.column("source")[b].values.to_numpy()[at]])
        values.append(blocks.column("n")[b].values.to_numpy()[at])
    if not keys:
        none = np.zeros(0, np.int64)
        return [], sources, none, none, none
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return kept, sources, keys[first] // len(sources), keys[first] % len(sources), np.add.reduceat(values, first)


def frequencies(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, n) of the kept terms; source NULL stands for the whole language."""

    def merge(key: tuple, blocks: pa.Table) -> pa.Table:
        terms, sources, term, source, n = merge_runs(blocks, min_docs)
        totals = np.add.reduceat(n, np.searchsorted(term, np.arange(len(terms)))) if terms else n
        names = pa.array(terms, pa.binary()).cast(pa.string())
        of = pa.array([*sources, None], pa.string())
        term, source, n = (np.concatenate(x) for x in (
            (term, np.arange(len(terms))), (source, np.full(len(terms), len(sources))), (n, totals)))
        lang = pa.array([key[1].as_py()], pa.string()).take(pa.array(np.zeros(len(n), np.int64)))
        return pa.table({"lang": lang, "term": names.take(pa.array(term)), "source": of.take(pa.array(source)), "n": pa.array(n)})

    return found.where("shard >= 0").groupBy("shard", "lang").applyInArrow(merge, "lang string, term string, source string, n long")


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / whole), in three steps of a thousand, so that nothing overflows."""
    rest, out = n.astype(np.int64), np.zeros(len(n), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_PARTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def corrections(lang: str, postings: pa.Table, groups: pa.Table, top: int) -> Iterator[pa.RecordBatch]:
    """One group of a language's terms: for each two sources (the smaller name first) the sum
    over these terms beyond that of absent ones, and the first ``top`` terms of each source."""
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    number = dict(zip(names.to_pylist(), count()))
    v, salt = groups.column("v")[0].as_py(), groups.column("salt")[0].as_py()
    whole = np.maximum(groups.column("total").to_numpy() + 2 * v, 1)
    lang_whole = max(groups.column("lang_total")[0].as_py() + 2 * v, 1)
    absent = shares(np.full(len(whole), 2), whole)
    terms = sorted(set(postings.column("term").to_pylist()), key=str.encode)
    place = dict(zip(terms, count()))
    of = postings.column("source").to_pylist()
    term = np.fromiter(map(place.__getitem__, postings.column("term").to_pylist()), np.int64, len(of))
    n = postings.column("n").to_numpy()
    source = np.fromiter((-1 if name is None else number[name] for name in of), np.int64, len(of))
    here = source < 0
    q = np.zeros(len(terms), np.int64)
    q[term[here]] = shares(n[here] + 2, np.full(here.sum(), lang_whole))
    term, source, n = term[~here], source[~here], n[~here]
    order = np.lexsort((term, source))
    term, source, n = term[order], source[order], n[order]
    p = shares(n + 2, whole[source])

    def batch(part: str, sources: np.ndarray, items: pa.Array, values: np.ndarray) -> pa.RecordBatch:
        same = lambda value: pa.array([value], pa.string()).take(pa.array(np.zeros(len(values), np.int64)))
        return pa.RecordBatch.from_arrays(
            [same(lang), names.take(pa.array(sources)), same(part), items, pa.array(values)], schema=_PARTS)

    higher = np.flatnonzero((n > 0) & (p > q[term]))
    value = difference(p[higher], q[term[higher]])
    order = np.lexsort((term[higher], -value, source[higher]))
    chosen = source[higher][order]
    rank = np.arange(len(chosen)) - np.searchsorted(chosen, chosen)
    order = order[rank < top]
    yield batch("term", source[higher][order], pa.array(terms, pa.string()).take(pa.array(term[higher][order])), value[order])

    cuts = np.searchsorted(source, np.arange(len(names) + 1))
    for low in range(0, len(names), SOURCES):
        for first in range(0, len(names), SOURCES):
            yield batch("pair", *_pairs(
                (low, min(low + SOURCES, len(names))), (first, min(first + SOURCES, len(names))),
                names, absent, term, source, p, cuts, len(terms), v, salt == 0))


def _pairs(own: tuple[int, int], other: tuple[int, int], names: pa.Array, absent: np.ndarray, term: np.ndarray,
           source: np.ndarray, p: np.ndarray, cuts: np.ndarray, n_terms: int, v: int, complete: bool) -> tuple:
    """The sums that the terms of sources ``own`` add to pairs with sources ``other``. A term that
    both have is added once, from the smaller source. ``complete`` adds what ``v`` absent terms
    make and leaves out no pair."""
    sums = np.zeros((own[1] - own[0], other[1] - other[0]), np.int64)
    lower = np.arange(*own)[:, None] < np.arange(*other)[None, :]
    a0, b0 = absent[own[0]:own[1], None], absent[None, other[0]:other[1]]
    base = difference(a0, b0)
    if complete:
        sums += np.where(lower, base * v, 0)
    x, y = cuts[other[0]], cuts[other[1]]
    step = max(1, (1 << 20) // (other[1] - other[0]))
    i, j = cuts[own[0]], cuts[own[1]]
    mine = i + np.argsort(term[i:j], kind="stable")
    theirs = x + np.argsort(term[x:y], kind="stable")
    for low in range(0, n_terms, step):  # a window of terms streams past
        mine_here = mine[np.searchsorted(term[mine], low):np.searchsorted(term[mine], low + step)]
        if not len(mine_here):
            continue
        there = theirs[np.searchsorted(term[theirs], low):np.searchsorted(term[theirs], low + step)]
        shares_there = np.repeat(b0, min(step, n_terms - low), axis=0)
        shares_there[term[there] - low, source[there] - other[0]] = p[there]
        has = np.zeros(shares_there.shape, bool)
        has[term[there] - low, source[there] - other[0]] = True
        for part in np.array_split(mine_here, 1 + len(mine_here) // (1 << 13)):
            a, t = source[part] - own[0], term[part] - low
            more = difference(p[part][:, None], shares_there[t]) - base[a]
            more[has[t] & ~lower[a]] = 0
            np.add.at(sums, a, more)
    i, j = np.nonzero((sums != 0) | lower if complete else sums)
    a, b, values = i + own[0], j + other[0], sums[i, j]
    return np.minimum(a, b), names.take(pa.array(np.maximum(a, b))), values


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language all others by
    how far they are (part ``pair``), and the ``top`` terms that it uses more (``term``)."""
    volume = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    with small_batches(docs.sparkSession):
        spilled = stage(runs(docs, max(LEAST_SHARDS, volume // SHARD_BYTES), block_entries), "term-runs")
    kept = stage(frequencies(spilled.df, min_docs), "term-frequencies")
    return compare(spilled, kept, top)


def compare(spilled: Staged, kept: Staged, top: int) -> DataFrame:
    """Both parts from the runs (for the sources that occur) and the kept frequencies."""
    whole = F.col("source").isNull()
    langs = stage(kept.df.groupBy("lang").agg(
        F.count_if(whole).alias("v"), F.sum(F.when(whole, F.col("n"))).alias("lang_total"),
        F.expr(f"CAST(count(*) DIV {GROUP_POSTINGS} + 1 AS INT)").alias("salts")), "languages")
    totals = kept.df.where(~whole).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    present = spilled.df.where("shard = -1").select("lang", F.explode("sources").alias("source")).distinct()
    groups = present.join(totals, ["lang", "source"], "left").join(langs.side(), "lang", "left")
    groups = groups.fillna(0, ["total", "v", "lang_total"]).fillna(1, ["salts"])
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    salt = F.pmod(F.xxhash64("term"), F.col("salts")).cast("int")
    postings = kept.df.join(langs.side(langs.df.select("lang", "salts")), "lang").withColumn("salt", salt)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(corrections(key[0].as_py(), left, right, top)), _PARTS)

    parts = postings.select("lang", "salt", "term", "source", "n").groupBy("lang", "salt").cogroup(
        groups.select("lang", "salt", "source", "total", "v", "lang_total").groupBy("lang", "salt"))
    parts = stage(parts.applyInArrow(run, "lang string, source string, part string, item string, value long"), "divergence").df
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", sides.alias("s"), "value").select(
        "lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
