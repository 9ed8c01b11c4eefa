"""Near-duplicate classes by b-bit MinHash, confirmed on full shingle sets.

Every text becomes the set of its distinct word shingles. Texts with equal sets are
one vertex. Minima of ``HASHES`` hash functions are cut into bands; vertices that
agree in a band are candidates. Of the minima only the low ``BITS`` bits are kept,
packed into 64-bit words: differing bits are counted with xor and bit_count, and
the similarity estimated from them is corrected for agreements by chance. Pairs
estimated far below the threshold are dropped; all others are confirmed on the
full sets of both texts.

Pairs are never formed for all members of a band. Every vertex is compared with the
best of its bands' leaders, the members that share most bands, so a large group of
copies costs one comparison per copy. Members of bands that then still lie in
several classes, such as texts around one common passage, are compared by an exact
filter instead: of each set, ordered by how often its shingles occur there, only the
rarest few can be the first that is shared with a similar set, and only sets that
share one of these, early enough, become pairs. The order needs counts in a sketch
of fixed size; the result is the same for any order.

Defined cases: a NULL or empty text has an empty set and is linked with nothing. A
text with fewer words than a shingle is one shingle as a whole. Rows with equal
doc_id are in the classes of their texts. The class is named by its smallest
doc_id that is not NULL, and a row without doc_id is never the one that is kept.
Very long texts are read whole, in batches of their own. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.components import components
from factloom.llm.texts import column, column_bytes, forgetful, fresh, keyed, mix, shingles, small_batches, text_key
from factloom.sources.staging import Staged, stage

HASHES, ROWS, BITS = 128, 4, 4
BANDS, PER_WORD = HASHES // ROWS, 64 // BITS
WORDS = HASHES // PER_WORD
# Standard errors below the threshold at which a candidate is still compared in full.
SPARE = 5
CHUNK = 1 << 18
# Members that are compared with one copy of their leader's text.
GROUP = 256
# Places in which shingles are counted for their order.
SKETCH = 1 << 20
_random = np.random.default_rng(20240607)
MULTIPLIERS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, HASHES, np.uint64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, k, n_shingles, fp (of the whole set), packed low bits, and band hashes."""

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = column(batch, "doc_id"), column(batch, "k")
            start, held, total = 0, [], 0
            for text in column_bytes(batch, "text"):
                held.append(shingles(text.lower().split(), size) if text else np.zeros(0, np.uint64))
                total += len(held[-1])
                if total >= CHUNK:
                    yield _signed(ids.slice(start, len(held)), keys.slice(start, len(held)), held)
                    start, held, total = start + len(held), [], 0
            if held:
                yield _signed(ids.slice(start), keys.slice(start), held)

    return keyed(docs).mapInArrow(
        run, "doc_id long, k long, n_shingles long, fp binary, sig array<long>, bands array<long>")


def _signed(ids: pa.Array, keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    packed, bands = _sign([s for s in sets if len(s)])
    full = iter(zip(packed, bands))
    rows = [next(full) if len(s) else (None, None) for s in sets]
    return pa.RecordBatch.from_arrays([
        ids, keys, pa.array([len(s) for s in sets], pa.int64()),
        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
        pa.array([row[0] for row in rows], pa.list_(pa.int64())), pa.array([row[1] for row in rows], pa.list_(pa.int64())),
    ], names=["doc_id", "k", "n_shingles", "fp", "sig", "bands"])


def _sign(sets: list[np.ndarray]) -> tuple[list, list]:
    """Packed low bits and band hashes of some non-empty sets."""
    if not sets:
        return [], []
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    minima = np.empty((HASHES, len(sets)), np.uint64)
    for i in range(HASHES):
        minima[i] = np.minimum.reduceat(flat * MULTIPLIERS[i] + SHIFTS[i], starts)
    minima = mix(minima)
    low = (minima & np.uint64((1 << BITS) - 1)).reshape(WORDS, PER_WORD, -1)
    places = (np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS))[None, :, None]
    packed = np.bitwise_or.reduce(low << places, axis=1).astype(np.int64)
    bands = np.empty((BANDS, len(sets)), np.uint64)
    for j in range(BANDS):
        h = np.full(len(sets), j + 1, np.uint64)
        for i in range(j * ROWS, (j + 1) * ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C1B) + minima[i])
        bands[j] = h
    return list(packed.T), list(bands.astype(np.int64).T)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed bits, corrected for the 2**-BITS agreements by chance."""
    marks = sum(1 << BITS * i for i in range(PER_WORD))
    marks -= (marks >> 63) << 64
    differ = F.lit(0)
    for i in range(WORDS):
        x = a[i].bitwiseXOR(b[i])
        any_bit = x
        for shift in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(marks)))
    chance = 2.0**-BITS
    return ((F.lit(HASHES) - differ) / HASHES - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    share, chance = percent / 100, 2.0**-BITS
    agree = share + (1 - share) * chance
    return share - SPARE * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, k (the text's key), n_shingles, component_id, kept and n_links of every row.

    ``n_links`` counts the confirmed links of the row's vertex, of those that had to be
    compared. Sets are linked if 100 * intersection >= percent * union.
    """
    with small_batches(docs.sparkSession):
        signed = stage(signatures(docs, size), "signatures").df
    full = signed.where("fp IS NOT NULL")
    nodes = full.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "k")).alias("place"),
        F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"),
    ).select("fp", "least", "place.doc_id", "place.k", "sig", "bands", F.monotonically_increasing_id().alias("v"))
    nodes = stage(nodes, "vertices").df
    classes, links = _classes(docs, nodes, size, percent)

    named = nodes.select("fp", "v", "least").join(classes.side(), "v", "left").withColumn("c", F.coalesce("c", "v"))
    names = stage(named.groupBy("c").agg(F.min("least").alias("component")), "class-names")
    named = named.join(names.side(), "c").join(links, "v", "left")
    named = stage(named.select("fp", "component", F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    return signed.select("doc_id", "k", "n_shingles", "fp").join(named.side(), "fp", "left").select(
        "doc_id", "k", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        (F.col("fp").isNull() & F.col("doc_id").isNotNull() | F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False))).alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _classes(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> tuple[Staged, DataFrame]:
    """(v, c) of the vertices that have links, and their counts of links."""
    spread = nodes.select("v", F.explode("bands").alias("band"))
    shared = stage(spread.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "bands")
    members = stage(spread.join(shared.side(), "band"), "members").df
    degrees = stage(members.groupBy("v").agg(F.sum("m").alias("degree")), "degrees")
    ranked = members.join(degrees.side(), "v")
    leaders = stage(ranked.groupBy("band").agg(F.max_by("v", F.struct("degree", -F.col("v"))).alias("leader")), "leaders")
    first = members.join(leaders.side(), "band").where("v <> leader").select("v", F.col("leader").alias("w")).distinct()
    scored = _estimated(first, nodes, percent)
    pairs = scored.groupBy("v").agg(F.max_by("w", F.struct("estimate", -F.col("w"))).alias("w"))

    empty = docs.sparkSession.createDataFrame([], "v long, c long")
    classes = stage(empty, "classes")
    confirmed = _confirm(docs, nodes, pairs, size, percent)
    if confirmed.rows:
        classes = _merge(classes, confirmed)
    all_links = confirmed.df
    open_vertices = _open(members, classes)
    if open_vertices.rows:
        rest = _confirm(docs, nodes, _rest(docs, nodes, open_vertices, size, percent), size, percent)
        if rest.rows:
            classes = _merge(classes, rest)
        all_links = all_links.union(rest.df)
    links = all_links.select("a").union(all_links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("v")).agg(
        F.count(F.lit(1)).alias("n_links"))
    return classes, links


def _merge(classes: Staged, confirmed: Staged) -> Staged:
    """Classes after new links: links between classes are merged as a smaller graph."""
    at = lambda end, name: F.coalesce(F.col(name), F.col(end))
    known = classes.df
    joined = confirmed.df.join(classes.side(known.select(F.col("v").alias("a"), F.col("c").alias("_ca"))), "a", "left").join(
        classes.side(known.select(F.col("v").alias("b"), F.col("c").alias("_cb"))), "b", "left")
    merged = components(joined.select(at("a", "_ca").alias("a"), at("b", "_cb").alias("b")))
    moved = merged.df.select(F.col("v").alias("c"), F.col("c").alias("_to"))
    relabelled = known.join(merged.side(moved), "c", "left").select("v", F.coalesce("_to", "c").alias("c"))
    return stage(relabelled.unionByName(merged.df).groupBy("v").agg(F.min("c").alias("c")), "classes")


def _open(members: DataFrame, classes: Staged) -> Staged:
    """(v, c) of the members of bands that still lie in several classes."""
    placed = members.join(classes.side(), "v", "left").select("band", "v", F.coalesce("c", "v").alias("c"))
    several = placed.groupBy("band").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).where("_lo < _hi").select("band")
    several = stage(several, "open-bands")
    return stage(placed.join(several.side(), "band", "left_semi").select("v", "c").distinct(), "open")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, text) of some vertices."""
    places = stage(nodes.select("v", F.col("doc_id").alias("_doc"), F.col("k").alias("_k")).join(wanted, "v", "left_semi"), "places")
    found = keyed(docs).alias("d").join(places.side(), F.expr("d.doc_id <=> _doc AND d.k = _k"))
    return found.select("v", "text")


def _rest(docs: DataFrame, nodes: DataFrame, open_vertices: Staged, size: int, percent: int) -> DataFrame:
    """Pairs (v, w) of different classes, among them all that are similar enough.

    With sets ordered alike, sets with an overlap of at least o share a shingle among
    the first n - o + 1 of each. For the larger set of a pair o is at least percent of
    its own size; for the smaller one, percent of the mean size and more.
    """
    spark = docs.sparkSession
    texts = _texts(docs, nodes, open_vertices.df.select("v")).dropDuplicates(["v"])
    texts = stage(texts, "open-texts").df.join(open_vertices.side(), "v")

    @forgetful
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for text in column_bytes(batch, "text"):
                seen += np.bincount(shingles(text.lower().split(), size) % np.uint64(SKETCH), minlength=SKETCH)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["place", "n"])

    with small_batches(spark):
        got = stage(texts.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")), "sketch")
    got = got.df.toArrow()  # at most SKETCH rows, whatever the table's size
    often = np.zeros(SKETCH, np.int64)
    often[got.column("place").to_numpy()] = got.column("n").to_numpy()
    sent = spark.sparkContext.broadcast(often)

    @forgetful
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v, c, text in zip(column(batch, "v").to_pylist(), column(batch, "c").to_pylist(), column_bytes(batch, "text")):
                own = shingles(text.lower().split(), size)
                n = len(own)
                order = np.lexsort((own, sent.value[own % np.uint64(SKETCH)]))[: n - -(-percent * n // 100) + 1]
                # A place that counts one is no other set's.
                at = np.flatnonzero(sent.value[own[order] % np.uint64(SKETCH)] > 1)
                short = at < n - -(-2 * percent * n // (100 + percent)) + 1
                fill = lambda x: pa.array(np.full(len(at), x, np.int64))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [fill(v), fill(c), fill(n), pa.array(own[order[at]].view(np.int64)), pa.array(at), pa.array(short)],
                    names=["v", "c", "n", "shingle", "at", "short"])

    with small_batches(spark):
        early = stage(texts.mapInArrow(first, "v long, c long, n long, shingle long, at long, short boolean"), "rare-shingles").df
    several = early.groupBy("shingle").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi"), F.max("short").alias("_s"))
    several = stage(several.where("_lo < _hi AND _s").select("shingle"), "rare-shared")
    early = early.join(several.side(), "shingle")
    smaller = early.where("short").select("shingle", F.col("v").alias("w"), F.col("c").alias("cw"), F.col("n").alias("nw"), F.col("at").alias("atw"))
    pairs = early.join(smaller, "shingle").where(
        f"c <> cw AND nw <= n AND 100 * nw >= {percent} * n AND (100 + {percent}) * least(n - at, nw - atw) >= {percent} * (n + nw)")
    pairs = pairs.select(F.greatest("v", "w").alias("v"), F.least("v", "w").alias("w")).distinct()
    return _estimated(pairs, nodes, percent).select("v", "w")


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(v, w, estimate) of the pairs that may reach the threshold."""
    pairs = stage(pairs, "pairs").df
    one = nodes.select("v", F.col("sig").alias("_a"))
    other = nodes.select(F.col("v").alias("w"), F.col("sig").alias("_b"))
    scored = pairs.join(one, "v").join(other, "w").select("v", "w", estimate(F.col("_a"), F.col("_b")).alias("estimate"))
    return scored.where(F.col("estimate") >= least_estimate(percent))


def _confirm(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> Staged:
    """(a, b) of the pairs whose full sets are similar enough."""
    pairs = stage(pairs.select("v", "w"), "candidates")
    if not pairs.rows:
        return stage(pairs.df.select(F.col("v").alias("a"), F.col("w").alias("b")), "links")
    # A leader's members are dealt to groups of bounded size; each gets the leader's text once.
    sizes = stage(pairs.df.groupBy("w").agg(F.count(F.lit(1)).alias("m")), "leader-sizes")
    groups = F.expr(f"CAST(m DIV {GROUP} + 1 AS INT)")
    members = pairs.df.join(sizes.side(), "w").select("v", "w", F.pmod(F.xxhash64("v"), groups).cast("int").alias("g"))
    heads = sizes.df.select(F.col("w").alias("v"), "w", F.explode(F.sequence(F.lit(0), groups - 1)).alias("g"))
    placed = stage(members.unionByName(heads), "compared")
    texts = _texts(docs, nodes, placed.df.select("v").distinct()).join(placed.side(), "v")
    ordered = texts.repartition("w", "g").sortWithinPartitions("w", "g", F.col("v") != F.col("w"), "v")

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own, last = None, None, None
        for batch in batches:
            found = []
            keys = zip(*(column(batch, name).to_pylist() for name in ("w", "g", "v")))
            for (w, g, v), text in zip(keys, column_bytes(batch, "text")):
                if (w, g, v) == last:  # a repeated row of one document
                    continue
                last = w, g, v
                words = shingles(text.lower().split(), size)
                if v == w:
                    leader, own = (w, g), words
                elif leader == (w, g):
                    both = len(np.intersect1d(own, words, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(words) - both):
                        found.append((v, w))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    with small_batches(docs.sparkSession):
        return stage(ordered.select("w", "g", "v", "text").mapInArrow(run, "a long, b long").distinct(), "links")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, columns as they were: of each class the one
    with the smallest doc_id, and one of equal rows. A row without doc_id stays only if its class
    has no row with one."""
    doc, key, c, e, n = fresh(docs, "doc", "key", "class", "else", "rows")
    found = near_duplicates(docs, **options)
    stays = found.where(F.col("kept") | F.col("doc_id").isNull() & F.col("component_id").isNull())
    apart = F.when(F.col("component_id").isNull() | (F.col("n_shingles") == 0), F.col("k"))
    stays = stays.groupBy(F.col("doc_id").alias(doc), F.col("component_id").alias(c), apart.alias(e)).agg(
        F.min("k").alias(key), F.count(F.lit(1)).alias(n)).drop(c, e)
    stays = stage(stays, "kept", metrics={"several": F.count_if(F.col(n) > 1)})
    own = fresh(docs, "own")[0]
    with_key = docs.withColumn(own, text_key(F.col("text").cast("string")))
    same = F.expr(f"CAST(doc_id AS BIGINT) <=> {doc} AND {own} = {key}")
    kept = with_key.join(stays.side(stays.df.where(f"{n} = 1").drop(n)), same, "left_semi")
    if stays.metrics["several"]:
        several = with_key.join(stays.side(stays.df.where(f"{n} > 1").drop(n)), same, "left_semi")
        kept = kept.unionByName(several.dropDuplicates(["doc_id", own]))
    return kept.drop(own)
