"""Approximate nearest neighbours with learned partitions.

A bounded sample gives a neighbour graph, which is split into parts of nearly equal
size that cut few of its edges. A small classifier (multinomial logistic
regression) learns from each vector the parts of its neighbours. It assigns every
row of the table to one part, and every query to its most probable parts, as many
as the sample needs to find ``target`` of its neighbours. Within parts, blocks of
bounded size are scored exactly, and the best of all blocks are ranked.

A part may hold any share of the table: its rows and its queries are dealt into
blocks by hash, and each block of rows meets each block of queries of its part.

Defined cases: NULL and zero vectors, vectors with NULL or non-finite components,
vectors without id and vectors of another length than most take no part. A query's
own row is no candidate, but another row with the same id is. A query whose probed
parts hold fewer than ``k`` candidates probes all others too, so it gets ``k`` wherever
there are as many. Repeated rows are candidates each. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.staging import stage

SAMPLE_ROWS = 8192
PARTS = 32
NEIGHBOURS = 10
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
RESULT = "qrow long, query_id long, vec_id long, row long, score double"


@dataclass(frozen=True)
class Router:
    weights: np.ndarray  # dimension x parts
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and a row number of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors").df
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["d"] if sizes else 0))


def fit(rows: DataFrame, parts: int = PARTS, sample_rows: int = SAMPLE_ROWS, k: int = 20, target: float = 0.97) -> Router | None:
    """Learns from at most ``sample_rows`` rows, the first by hash of their number."""
    got = rows.select("row", "embedding").orderBy(F.xxhash64("row"), "row").limit(sample_rows).toArrow()
    if not got.num_rows:
        return None
    x = _matrix(got.column("embedding"))
    parts = max(1, min(parts, len(x) // 16))
    near = _neighbours(x, min(max(NEIGHBOURS, k), len(x) - 1))
    if parts == 1 or near.shape[1] == 0:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    part = _balanced(x, near[:, :NEIGHBOURS], parts)
    weights, bias = _classifier(x, part, near[:, :NEIGHBOURS], parts)
    router = Router(weights, bias, parts)
    # As many parts as find the target share of neighbours in the sample, and one more.
    order = np.argsort(-router.scores(x), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    ranks = np.take_along_axis(place, order[:, 0][near[:, :k]], axis=1)
    share = [(ranks < m).mean() for m in range(1, parts + 1)]
    probes = next((m for m, s in enumerate(share, 1) if s >= target), parts)
    return Router(weights, bias, min(parts, probes + 1))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _neighbours(x: np.ndarray, k: int) -> np.ndarray:
    near = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 1024):
        scores = x[start: start + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        if k:
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            order = np.argsort(-np.take_along_axis(scores, top, axis=1), axis=1, kind="stable")
            near[start: start + len(scores)] = np.take_along_axis(top, order, axis=1)
    return near


def _balanced(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Parts of the neighbour graph: grown around spread seeds, then each vertex moves to
    the part of most of its neighbours, as long as that part has room."""
    n, room = len(x), int(1.1 * len(x) / parts) + 1
    rng = np.random.default_rng(7)
    seeds = [int(rng.integers(n))]
    closest = x @ x[seeds[0]]
    while len(seeds) < parts:
        seeds.append(int(np.argmin(closest)))
        closest = np.maximum(closest, x @ x[seeds[-1]])
    centres = x[seeds]
    for _ in range(8):
        part = _with_room(x @ centres.T, room)
        for p in range(parts):
            own = x[part == p]
            if len(own):
                centres[p] = own.sum(axis=0)
                centres[p] *= np.sqrt((own**2).sum(axis=1).mean()) / max(np.linalg.norm(centres[p]), 1e-12)
    edges = [[] for _ in range(n)]
    for i, row in enumerate(near.tolist()):
        for j in row:
            edges[i].append(j)
            edges[j].append(i)
    sizes = np.bincount(part, minlength=parts)
    for _ in range(10):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[edges[i]], minlength=parts)
            votes[(sizes >= room) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def _with_room(scores: np.ndarray, room: int) -> np.ndarray:
    """The best part of each row; where one is full, the next, surest rows first."""
    order = np.argsort(-scores, axis=1, kind="stable")
    top = np.take_along_axis(scores, order[:, : min(2, scores.shape[1])], axis=1)
    part, sizes = np.empty(len(scores), np.int64), np.zeros(scores.shape[1], np.int64)
    for i in np.argsort(top[:, -1] - top[:, 0], kind="stable"):
        for p in order[i]:
            if sizes[p] < room:
                part[i] = p
                sizes[p] += 1
                break
    return part


def _classifier(x: np.ndarray, part: np.ndarray, near: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Learns the share of each part among a vector and its neighbours (Adam, full batch)."""
    aim = np.zeros((len(x), parts))
    rows = np.arange(len(x))
    np.add.at(aim, (rows, part), 2.0)
    for column in near.T:
        np.add.at(aim, (rows, part[column]), 1.0)
    aim /= aim.sum(axis=1, keepdims=True)
    scale = max(np.sqrt((x**2).sum(axis=1).mean()), 1e-12)
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    w, m, v = (np.zeros((z.shape[1], parts)) for _ in range(3))
    for step in range(1, 201):
        logits = z @ w
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = z.T @ (p - aim) / len(x) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1] / scale, w[-1]


def search(vectors: DataFrame, is_query, k: int = 20, router: Router | None = None, parts: int = PARTS,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of each query.

    ``is_query`` is a condition on vec_id; the candidates are all rows but the query's
    own. Scores are inner products in double precision.
    """
    rows = usable(vectors)
    router = router or fit(rows, parts, sample_rows, k)
    if router is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.where(is_query)
    total, probes = rows.count(), router.probes

    def assigned(first: int, last: int | None = None):
        """To each row its most probable parts, from one place to another."""
        def run(batches):
            for batch in batches:
                x = _matrix(batch.column(2))
                best = np.argsort(-router.scores(x), axis=1, kind="stable")[:, first:last].astype(np.int32)
                at = np.repeat(np.arange(len(x)), best.shape[1])
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(best.ravel())], names=["row", "vec_id", "embedding", "part"])

        return run

    schema = "row long, vec_id long, embedding array<float>, part int"
    columns = ["row", "vec_id", "embedding"]
    indexed = stage(rows.select(columns).mapInArrow(assigned(0, 1), schema), "index").df
    asking = stage(queries.select(columns).mapInArrow(assigned(0, probes), schema), "queries").df
    found = stage(_meeting(indexed, asking, k), "found")
    counts = found.df.groupBy("qrow").agg(F.count(F.lit(1)).alias("n"))
    few = queries.select(columns).join(counts, F.col("row") == F.col("qrow"), "left").where(F.coalesce("n", F.lit(0)) < min(k, total - 1))
    few = stage(few.select(columns), "queries-with-few")
    every = found.df
    if few.rows:
        rest = stage(few.df.mapInArrow(assigned(probes), schema), "other-parts").df
        every = every.unionByName(_meeting(indexed, rest, k))
    order = Window.partitionBy("qrow").orderBy(F.desc("score"), "vec_id", "row")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _meeting(indexed: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """RESULT: the ``k`` best of every query and block of a part that it probes."""
    columns = ["row", "vec_id", "embedding"]
    # One row per part, and there are ``parts`` of them.
    blocks = indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("nc"))
    asked = asking.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("nq"))
    plan = F.broadcast(blocks.join(asked, "part"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    left = asking.join(plan, "part").select(*columns, "part", dealt("nq").alias("qb"), each("nc").alias("cb"))
    right = indexed.join(plan, "part").select(*columns, "part", dealt("nc").alias("cb"), each("nq").alias("qb"))

    def score(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(("qrow", "query_id", "vec_id", "row", "score"), (*[pa.int64()] * 4, pa.float64()))})
        a, b = _matrix(q.column("embedding")), _matrix(c.column("embedding"))
        ids, numbers = c.column("vec_id").to_numpy(), c.column("row").to_numpy()
        own = q.column("row").to_numpy()
        rough = a @ b.T
        out_q, out_c, out_s = [], [], []
        for i in range(len(a)):
            line = rough[i]
            take = min(k + 1, len(b))
            least = np.partition(line, len(b) - take)[len(b) - take]
            # Products added in another order differ in the last bits: keep what is that close.
            some = np.flatnonzero(line >= least - 1e-9 * (abs(least) + 1))
            some = some[numbers[some] != own[i]]
            exact = (b[some] * a[i]).sum(axis=1)
            best = np.lexsort((numbers[some], ids[some], -exact))[:k]
            out_q.append(np.full(len(best), i))
            out_c.append(some[best])
            out_s.append(exact[best])
        at, of, s = np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)
        return pa.table({"qrow": pa.array(own[at]), "query_id": pa.array(q.column("vec_id").to_numpy()[at]),
                         "vec_id": pa.array(ids[of]), "row": pa.array(numbers[of]), "score": pa.array(s)})

    keys = ["part", "qb", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, RESULT)


def recall(vectors: DataFrame, found: DataFrame, is_query, k: int = 20, most_queries: int = 500) -> float:
    """Share of the true nearest (by id) among those found, over at most ``most_queries``
    queries, which meet all rows in broadcast blocks."""
    rows = usable(vectors)
    asked = rows.where(is_query).orderBy(F.xxhash64("row"), "row").limit(most_queries).toArrow()
    a, own, qids = _matrix(asked.column("embedding")), asked.column("row").to_numpy(), asked.column("vec_id").to_pylist()

    def run(batches):
        for batch in batches:
            b, ids, numbers = _matrix(batch.column(1)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            exact = a @ b.T
            exact[own[:, None] == numbers[None, :]] = -np.inf
            take = min(k, len(b))
            top = np.argpartition(-exact, take - 1, axis=1)[:, :take]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(qids), take)), pa.array(ids[top].ravel()), pa.array(np.take_along_axis(exact, top, 1).ravel())],
                names=["query_id", "vec_id", "score"])

    true = rows.select("vec_id", "embedding", "row").mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = true.where("score > double('-inf')").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    hit = true.join(found.select("query_id", "vec_id").distinct(), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(true.count(), 1)
