"""Alignment of the tokens of two tokenizers over the same texts.

Each text is encoded whole by both. A place where a token of either side begins with
a blank, and where both sides have come to the same byte, is an anchor. Anchors cut the
texts into windows, each the token ids of both sides between two of them. What a window
holds (its groups, and which tokens overlap) depends on its ids alone. So windows are
told apart by their id tuples, found by hash and compared in full, each different one of
some megabytes of text is aligned once, and its alignment serves all its occurrences.

The second encoder is held to words as well: a vocabulary in which no piece holds a
blank after other characters joins nothing across the start of a word, so the ids of a
text are those of its words in turn, and words repeat. Other vocabularies, and texts
with blanks in a row, are given whole texts. A test holds both against the library's
own encoding of whole texts.

Per text the different id pairs are kept with their numbers. How many documents hold a
pair is counted from these with a partial count per task. Pairs in one document only
need no row of their own, unless they are the most frequent of their first id; the rest
is broadcast if measured small, and joined by shuffle otherwise.

Defined cases: NULL and empty texts, and texts that an encoder does not give back byte by
byte, have no tokens: zeros, and an empty digest. Rows with one doc_id are judged one
by one, also equal ones. Very long texts are encoded whole, in a turn of their own. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import Spans, column, mix, small_batches
from factloom.llm.tokens import encoder, ranks
from factloom.sources.staging import stage

TURN_CHARS = 1 << 20  # texts that share their windows' alignments
BLANK = "\u2581"


class Pieces:
    """Encoding with a sentence-piece file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(BLANK, " ").encode()
                      for i, name in enumerate(names)]
        self.by_word = not any(BLANK in name.lstrip(BLANK) for name in names)

    def plain(self, text: str) -> bool:
        """Whether the ids of a text are those of its words."""
        return self.by_word and "  " not in text and BLANK not in text and text[0] != " " and text[-1] != " "

    def true(self, text: str, ids: list[int]) -> bool:
        """Whether ids give back a text and the blank before it."""
        return b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many each text has, and whether they give it back."""
        plain = np.array([self.plain(text) for text in texts], bool)
        parts, sizes = [np.zeros(0, np.int32)] * len(texts), np.zeros(len(texts), np.int64)
        good = np.ones(len(texts), bool)
        if plain.any():
            split = pc.split_pattern(pa.array([t for t, yes in zip(texts, plain) if yes], pa.large_string()), " ")
            coded = pc.list_flatten(split).dictionary_encode()
            known = coded.dictionary.to_pylist()
            found = self.model.encode(known, num_threads=1)
            lengths = np.fromiter(map(len, found), np.int64, len(known))
            flat = list(chain.from_iterable(found))
            right = np.ones(len(known), bool)
            if not self.true(" ".join(known), flat):  # else each of them is
                right = np.fromiter(map(self.true, known, found), bool, len(known))
            flat = np.array(flat, np.int32)
            which = coded.indices.to_numpy(zero_copy_only=False)
            ids = flat[_ranges(np.cumsum(lengths) - lengths, lengths, which)]
            first = np.asarray(split.offsets)[:-1]
            good[plain] = np.logical_and.reduceat(right[which], first)
            sizes[plain] = np.add.reduceat(lengths[which], first)
            for at, part in zip(np.flatnonzero(plain), np.split(ids, np.cumsum(sizes[plain])[:-1])):
                parts[at] = part
        for at in np.flatnonzero(~plain):
            found = self.model.encode(texts[at], num_threads=1)
            parts[at], sizes[at], good[at] = np.array(found, np.int32), len(found), self.true(texts[at], found)
        return np.concatenate([*parts, np.zeros(0, np.int32)]), sizes, good


def _ranges(starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The places of some ranges, one after the other."""
    n = lengths[which]
    ends = np.cumsum(n)
    return np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def _union(a: np.ndarray, b: np.ndarray, shared: bool = False) -> np.ndarray:
    """The values of two increasing arrays, each once; or those that both have."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    again = both[1:] == both[:-1]
    return both[1:][again] if shared else both[np.concatenate([[True], ~again])]


class Aligner:
    """Both encoders, with the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        self.a, self.b = encoder(first), Pieces(second)
        known = ranks(first)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.a_bytes[i] = token
        self.a_lengths, self.b_lengths = (np.array([*map(len, x)], np.int64) for x in (self.a_bytes, self.b.bytes))
        self.a_marked, self.b_marked = (np.array([t[:1] == b" " for t in x]) for x in (self.a_bytes, self.b.bytes))
        self.width = len(self.b.bytes)
        # Every id as text before each of the separators.
        self.size = max(len(self.a_bytes), self.width)
        self.pieces = [f"{i}{mark}" for mark in ",|;\n" for i in range(self.size)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their numbers per text for both sides, and which texts are given back by both."""
        found, good = [], np.ones(len(texts), bool)
        for i, text in enumerate(texts):
            ids = self.a.encode(" " + text)
            good[i] = b"".join(map(self.a_bytes.__getitem__, ids)) == b" " + text.encode()
            found.append(np.array(ids, np.int32))
        a, n_a = np.concatenate([*found, np.zeros(0, np.int32)]), np.array([*map(len, found)], np.int64)
        b, n_b, right = self.b.encode(texts)
        good &= right
        return a[np.repeat(good, n_a)], n_a * good, b[np.repeat(good, n_b)], n_b * good, good

    def align(self, texts: list[str]) -> tuple:
        """Per text n_a, n_b, n_groups, n_links and the digest of its groups; then, as one
        list, the different pair codes of the texts, their times, and how many each has."""
        a, n_a, b, n_b, good = self.encode(texts)
        n_groups, n_links, distinct = (np.zeros(len(texts), np.int64) for _ in range(3))
        digests = [""] * len(texts)
        if not good.any():
            return n_a, n_b, n_groups, n_links, digests, np.zeros(0, np.int64), np.zeros(0, np.int64), distinct
        # Both sides of a text have the same bytes, so all texts can be laid in a row.
        a_end, b_end = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        a_at, b_at = a_end - self.a_lengths[a], b_end - self.b_lengths[b]
        begins = a_at[(np.cumsum(n_a) - n_a)[good]]
        anchors = _union(a_at[self.a_marked[a]], b_at[self.b_marked[b]], shared=True)
        anchors = _union(anchors, begins)
        i, j = (np.append(np.searchsorted(at, anchors), len(at)) for at in (a_at, b_at))
        which, chosen = _same_windows(a, i, b, j)
        codes, n_codes, groups, lines = self.windows(a, i, b, j, chosen)

        first = np.searchsorted(anchors, begins)  # the first window of each text
        rows = np.flatnonzero(good)
        n_groups[rows] = np.add.reduceat(groups[which], first)
        n_links[rows] = np.add.reduceat(n_codes[which], first)
        for row, low, high in zip(rows.tolist(), first.tolist(), [*first[1:].tolist(), len(which)]):
            digests[row] = hashlib.sha256(";".join([lines[k] for k in which[low:high].tolist()]).encode()).hexdigest()
        text = np.repeat(np.arange(len(rows)), n_links[rows])
        every = codes[_ranges(np.cumsum(n_codes) - n_codes, n_codes, which)]
        limit = len(self.a_bytes) * self.width
        every = np.sort(text * limit + every)
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        times = np.diff(np.append(new, len(every)))
        text, codes = np.divmod(every[new], limit)
        distinct[rows] = np.bincount(text, minlength=len(rows))
        return n_a, n_b, n_groups, n_links, digests, codes, times, distinct

    def windows(self, a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, chosen: np.ndarray) -> tuple:
        """Alignment of the chosen windows: the codes of the linked id pairs and how many each
        window has, the number of groups, and the groups as text."""
        size_a, size_b = np.diff(i), np.diff(j)
        a, b = a[_ranges(i[:-1], size_a, chosen)], b[_ranges(j[:-1], size_b, chosen)]
        a_end, b_end = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        window_end = a_end[np.cumsum(size_a[chosen]) - 1]
        # Between two neighbouring ends, of either side, lies one linked pair.
        ends = _union(a_end, b_end)
        at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        codes = a[at_a].astype(np.int64) * self.width + b[at_b]
        n_codes = np.diff(np.searchsorted(ends, window_end, "right"), prepend=0)
        shared = ends[(a_end[at_a] == ends) & (b_end[at_b] == ends)]
        groups = np.diff(np.searchsorted(shared, window_end, "right"), prepend=0)
        # The text: of each group the ids of one side, then of the other.
        group_a, group_b = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=len(shared)))])
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=len(shared)))])
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = a + self.size * (a_end == shared[group_a])
        last = np.isin(shared, window_end, assume_unique=True)
        order[np.arange(len(b)) + before_a[group_b + 1]] = b + self.size * np.where(b_end == shared[group_b], 2 + last[group_b], 0)
        lines = "".join(map(self.pieces.__getitem__, order.tolist())).split("\n")
        return codes, n_codes, groups, lines


def _same_windows(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the number of its id tuples, and for each number a window that has them."""
    hashes = [Spans(mix(ids.astype(np.uint64) + np.uint64(1))).of(at[:-1], at[1:]) for ids, at in ((a, i), (b, j))]
    _, chosen, which = np.unique(mix(hashes[0] + mix(hashes[1] ^ np.uint64(0x5851F42D4C957F2D))), return_index=True, return_inverse=True)
    model = chosen[which]
    same = np.ones(len(which), bool)
    for ids, at in ((a, i), (b, j)):
        n = np.diff(at)
        same &= n == n[model]
        compared = np.flatnonzero(same)
        equal = ids[_ranges(at[:-1], n, compared)] == ids[_ranges(at[:-1], n, model[compared])]
        same[compared] = np.logical_and.reduceat(equal, np.cumsum(n[compared]) - n[compared])
    alone = np.flatnonzero(~same)  # equal hashes of different ids
    which[alone] = len(chosen) + np.arange(len(alone))
    return which, np.concatenate([chosen, alone])


@cache
def aligner(first: str, second: str) -> Aligner:
    """One per Python worker."""
    return Aligner(first, second)


_TEXTS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "codes array<{0}>, times array<int>")


def _code_type(first: str, second: str) -> tuple[str, pa.DataType, int]:
    """Pair codes take 4 bytes if both vocabularies' product does; the second one's size."""
    own = aligner(first, second)
    small = len(own.a_bytes) * own.width < 1 << 31
    return ("int", pa.int32(), own.width) if small else ("long", pa.int64(), own.width)


def links(docs: DataFrame, first: str, second: str) -> DataFrame:
    """One row per document: counts, digest, and its different id pairs with their numbers."""
    name, kind, _ = _code_type(first, second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first, second)
        for batch in batches:
            texts, low = column(batch, "text").to_pylist(), 0
            while low < len(texts):
                high, held = low, 0
                while high < len(texts) and (high == low or held + len(texts[high] or "") <= TURN_CHARS):
                    held += len(texts[high] or "")
                    high += 1
                yield _aligned(own, batch.slice(low, high - low), texts[low:high], kind)
                low = high

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(run, _TEXTS.format(name))


def _aligned(own: Aligner, batch: pa.RecordBatch, texts: list[str | None], kind: pa.DataType) -> pa.RecordBatch:
    full = np.flatnonzero([bool(text) for text in texts])
    *numbers, digests, codes, times, distinct = own.align([texts[i] for i in full])

    def spread(values) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        out[full] = values
        return out

    every = np.full(len(texts), "", object)
    every[full] = digests
    ends = pa.array(np.concatenate([[0], np.cumsum(spread(distinct))]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [column(batch, "row"), column(batch, "doc_id"), *(pa.array(spread(values)) for values in numbers), pa.array(every, pa.string()),
         pa.ListArray.from_arrays(ends, pa.array(codes).cast(kind)), pa.ListArray.from_arrays(ends, pa.array(times).cast(pa.int32()))],
        names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])


def pair_counts(found: DataFrame, width: int) -> DataFrame:
    """(code, weight) of the pairs in several documents and of the best of each first id;
    weight is twice the number of documents, plus one if none of its first id has more."""
    counts = stage(found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    # At most one row per id of the first vocabulary.
    most = counts.df.groupBy(F.expr(f"CAST(code DIV {width} AS INT)").alias("a")).agg(F.max("n").alias("most"))
    joined = counts.df.withColumn("a", F.expr(f"CAST(code DIV {width} AS INT)")).join(F.broadcast(most), "a")
    return joined.where("n > 1 OR most = 1").select("code", F.expr("2 * n + CAST(n = most AS INT)").alias("weight"))


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    width = _code_type(first, second)[2]
    with small_batches(docs.sparkSession):
        found = stage(links(docs, first, second), "links").df
    weights = stage(pair_counts(found, width), "pair-weights")
    each = found.select("row", F.explode(F.arrays_zip("codes", "times")).alias("e")).select("row", "e.codes", "e.times")
    weight = F.coalesce("weight", F.lit(2))  # a pair of one document, and not the best of its first id
    sums = each.withColumnRenamed("codes", "code").join(weights.side(), "code", "left").groupBy("row").agg(
        F.sum(F.col("times") * (weight % 2)).alias("n_best"), F.sum(F.col("times") * F.expr("coalesce(weight, 2) DIV 2")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return found.drop("codes", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
