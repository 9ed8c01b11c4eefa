"""Registered queries: each runs an operator or job over whole tables, with the
SQL that gives the same rows on another engine."""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factloom.functions.hashing import portable_hash, with_keys  # noqa: E402
from factloom.functions.text import contains_all, sentence  # noqa: E402
from factloom.functions.vectors import check_dim, to_json_text, to_vector  # noqa: E402
from factloom.operators import answers, filters, group_state, keyword_index, ledger, search  # noqa: E402
from factloom.operators.embed import HashingEmbedder, embed, embed_distinct  # noqa: E402
from factloom.operators.enrich import enrich, group_max  # noqa: E402
from factloom.operators.merge import (  # noqa: E402
    MergeResult,
    apply_merge,
    classify,
    duplicate_keys,
    merge_plan,
    stage_source,
)
from factloom.operators.prompts import GREETING, HYBRID, VECTOR_ONLY  # noqa: E402
from factloom.operators.terms import LONGEST  # noqa: E402
from factloom.plans import answering, loads  # noqa: E402
from factloom.schemas import CSV_FORMAT, ROW_HASH, ROW_KEY, VECTOR_DIM  # noqa: E402
from factloom.sources import inference, tables  # noqa: E402
from factloom.sources.landing import read_landing  # noqa: E402
from factloom.sources.staging import scratch_path, stage  # noqa: E402
from factloom.streaming.landing import merge_new_files  # noqa: E402

# The operators for training data are a part that may be absent; nothing else needs it.
try:
    import corpus_pipeline
    from factloom.llm import queries as llm_queries
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "factloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """The main query: keyword and vector retrieval for a table of questions."""
    return hybrid_topk(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: query for name, (query, _) in _REGISTRY.items()}
    if llm_queries is not None:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in _REGISTRY.items() if sql is not None}
    if llm_queries is not None:
        found |= llm_queries.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _register(sql: str | None):
    def add(query):
        _REGISTRY[query.__name__] = (query, sql)
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# --- Sources, group measures, keys ----------------------------------------------


@_register("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files: texts with quotes and line breaks, to CSV and back."""
    documents = _table(spark, sf_dir, "documents")
    path = scratch_path(spark, "landing")
    documents.write.options(**CSV_FORMAT).csv(path)
    return read_landing(spark, path, documents.schema)


@_register("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing files, each read by many tasks in byte ranges of 256 KB."""
    documents = _table(spark, sf_dir, "documents")
    path = scratch_path(spark, "landing")
    documents.write.options(**CSV_FORMAT).csv(path)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        return stage(read_landing(spark, path, documents.schema, split=True), "split-scan").df
    finally:
        spark.conf.set(size, before)


_TYPED = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"),
}

_TYPES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c}::varchar AS t FROM {table}" for table, columns in _TYPED.items() for c in columns)


@_register(f"""
    WITH texts AS ({_TYPES_SQL}),
    marked AS (
        SELECT column_name, t, regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') AND NOT regexp_matches(t, '^[+-]?0[0-9]') AS number,
               regexp_full_match(t, '[+-]?[0-9]+') AND NOT regexp_matches(t, '^[+-]?0[0-9]') AS whole,
               try_cast(t AS timestamp) IS NOT NULL AND t LIKE '____-__-__ %' AS time
        FROM texts),
    states AS (
        SELECT column_name, count(t) AS n_values, count_if(whole) AS n_whole, count_if(number) AS n_numbers, count_if(time) AS n_times,
               coalesce(max(length(regexp_extract(t, '^[+-]?0*([0-9]*)', 1))) FILTER (number), 0)::int AS digits_before,
               coalesce(max(length(regexp_extract(t, '\\.([0-9]*)$', 1))) FILTER (number), 0)::int AS digits_after
        FROM marked GROUP BY ALL)
    SELECT column_name, n_values, digits_before, digits_after,
           CASE WHEN n_whole = n_values AND digits_before <= 9 THEN 'int' WHEN n_whole = n_values THEN 'bigint'
                WHEN n_numbers = n_values THEN 'decimal(' || greatest(1, digits_before + digits_after) || ',' || digits_after || ')'
                WHEN n_times = n_values THEN 'timestamp_ntz' ELSE 'string' END AS type
    FROM states
""")
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of landed files, exact to the digit: the files hold nothing but texts."""
    found = None
    for table, columns in _TYPED.items():
        path = scratch_path(spark, "landing")
        rows = _table(spark, sf_dir, table).select(*[F.col(c).cast("string") for c in columns])
        rows.write.options(**CSV_FORMAT).csv(path)
        texts = read_landing(spark, path, rows.schema, split=True)
        states = inference.states(texts).select(
            F.col("column").alias("column_name"), F.col("values").alias("n_values"), F.col("before").alias("digits_before"),
            F.col("after").alias("digits_after"), inference.type_of().alias("type"))
        found = states if found is None else found.unionByName(states)
    return found


@_register("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           max(l_extendedprice) OVER (PARTITION BY l_suppkey) AS supplier_max
    FROM lineitem
""")
def group_max_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximum per group next to every row."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    return group_max(lines, "l_suppkey", "l_extendedprice", "supplier_max")


@_register("""
    SELECT c_custkey, md5(concat_ws('|', c_name, c_nationkey::varchar,
               (c_acctbal::decimal(18,2))::varchar, c_mktsegment)) AS change_hash
    FROM customer
""")
def change_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change hash in the form that other engines can reproduce."""
    payload = [F.col("c_name"), F.col("c_nationkey"), _money("c_acctbal"), F.col("c_mktsegment")]
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", portable_hash(payload).alias("change_hash")
    )


@_register("""
    SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
           count(DISTINCT (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) AS n_hashes
    FROM orders
""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and change hashes are as distinct as what they stand for."""
    keyed = with_keys(_table(spark, sf_dir, "orders"), ["o_orderkey"])
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(ROW_KEY).alias("n_keys"),
        F.countDistinct(ROW_HASH).alias("n_hashes"),
    )


_CUSTOMER_LOAD = loads.LoadSpec(
    keys=("c_custkey",), group="c_nationkey", value="c_acctbal", group_max="nation_max", buckets=8
)


@_register("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           max(c_acctbal) OVER (PARTITION BY c_nationkey) AS nation_max,
           count(*) OVER () AS rows_written
    FROM customer
""")
def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load: enrich, overwrite, read back."""
    path = scratch_path(spark, "table")
    rows = loads.initial_load(_table(spark, sf_dir, "customer"), path, _CUSTOMER_LOAD)
    stored = tables.read_current(spark, path).drop(ROW_KEY, ROW_HASH)
    return stored.withColumn("rows_written", F.lit(rows).cast("long"))


@_register("""
    SELECT count(*) AS loaded, 0::bigint AS inserted, 0::bigint AS updated, count(*) AS unchanged,
           count(*) AS documents
    FROM orders
""")
def load_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All load steps over landed files: full load, the same rows as a delta, vectors."""
    orders = _table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing")
    orders.write.options(**CSV_FORMAT).csv(landing)
    spec = loads.LoadSpec(
        schema=orders.schema, keys=("o_orderkey",), group="o_custkey", value="o_totalprice",
        group_max="largest_order", buckets=8,
        sentence=("The order", "{o_orderkey}", "has the priority", "{o_orderpriority}"),
    )
    done = loads.run(spark, landing, scratch_path(spark, "table"), scratch_path(spark, "table"), spec)
    return _counts(spark, done.merged).select(
        F.lit(done.loaded).cast("long").alias("loaded"), "inserted", "updated", "unchanged",
        F.lit(done.documents).cast("long").alias("documents"),
    )


@_register("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count that the write itself observes."""
    lines = with_keys(
        _table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    )
    rows = tables.overwrite(lines, scratch_path(spark, "table"), ROW_KEY, 8)
    return spark.range(1).select(F.lit(rows).cast("long").alias("n_rows"))


@_register("""
    SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'nothing', 0
""")
def stored_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of stored tables, written, appended to and merged, from their footers alone."""
    paths = {name: scratch_path(spark, "table") for name in ("lineitem", "orders", "nothing")}
    lines = with_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    tables.overwrite(lines.where("l_returnflag <> 'R'"), paths["lineitem"], ROW_KEY, 8)
    tables.append(lines.where("l_returnflag = 'R'"), paths["lineitem"], ROW_KEY)
    orders = _table(spark, sf_dir, "orders")
    tables.overwrite(with_keys(_merge_target(orders), ["o_orderkey"]), paths["orders"], ROW_KEY, 8)
    apply_merge(spark, paths["orders"], with_keys(_merge_batch(orders), ["o_orderkey"]), ["o_orderkey"])
    tables.create_or_replace(spark, paths["nothing"], lines.schema, 8)
    counts = tables.stored_row_counts(spark, paths)
    rows = [(name, sum(buckets.values())) for name, buckets in counts.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows long")


# --- Merge ----------------------------------------------------------------------
# The target holds the orders up to 1997; the batch brings those since 1996, with
# a new price for the pending ones. Every order is in one of them or in both.

_MERGE_SQL = """
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    batch AS (
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
    matched AS (
        SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey,
               coalesce(b.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
               coalesce(b.o_totalprice, t.o_totalprice) AS o_totalprice,
               CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'keep'
                    WHEN b.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'update'
                    ELSE 'unchanged' END AS action
        FROM target t FULL JOIN batch b ON t.o_orderkey = b.o_orderkey)
"""


def _merge_target(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))


def _merge_batch(orders: DataFrame) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
    return orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")).withColumn(
        "o_totalprice", price.otherwise(F.col("o_totalprice"))
    )


def _counts(spark: SparkSession, merged: MergeResult, label: str | None = None) -> DataFrame:
    counts = [
        F.lit(getattr(merged, name)).cast("long").alias(name)
        for name in ("inserted", "updated", "unchanged")
    ]
    return spark.range(1).select(*([F.lit(label).alias("run")] if label else []), *counts)


@_register("""
    WITH before AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
    tops AS (SELECT c_nationkey, max(c_acctbal) AS old_top FROM before GROUP BY ALL),
    after AS (
        SELECT c.c_custkey, c_nationkey, c_mktsegment, b.c_custkey IS NULL AS is_new,
               CASE WHEN n_regionkey = 2 AND b.c_acctbal = old_top THEN c.c_acctbal - 20000 ELSE c.c_acctbal END AS c_acctbal
        FROM customer c JOIN nation ON c_nationkey = n_nationkey LEFT JOIN tops USING (c_nationkey)
        LEFT JOIN (SELECT c_custkey, c_acctbal FROM before) b ON b.c_custkey = c.c_custkey),
    tops_after AS (SELECT c_nationkey, max(c_acctbal) AS nation_max FROM after GROUP BY ALL),
    marked AS (
        SELECT a.*, nation_max, nation_max IS DISTINCT FROM old_top AS moved, is_new OR a.c_acctbal <> c.c_acctbal AS changed
        FROM after a JOIN tops_after USING (c_nationkey) LEFT JOIN tops USING (c_nationkey) JOIN customer c USING (c_custkey)),
    counts AS (
        SELECT count_if(is_new)::bigint AS inserted, count_if(changed AND NOT is_new)::bigint AS updated,
               count(DISTINCT c_nationkey) FILTER (moved) AS groups_moved, count_if(moved AND NOT changed)::bigint AS rows_moved FROM marked)
    SELECT c_custkey, c_nationkey, c_acctbal, nation_max, inserted, updated, groups_moved, rows_moved FROM marked CROSS JOIN counts
""")
def incremental_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maxima of nations after customers of one segment arrive and the richest of each nation
    of region 2 lose their place: only rows of nations whose maximum moved are written again."""
    customers = _table(spark, sf_dir, "customer")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    known = customers.where("c_mktsegment <> 'BUILDING'")
    table, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    loads.initial_load(known, table, _CUSTOMER_LOAD)
    group_state.build(known, state, "c_nationkey", "c_acctbal")
    tops = group_max(known, "c_nationkey", "c_acctbal", "old_top").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    richest = tops.where("n_regionkey = 2 AND c_acctbal = old_top").select(*[F.col(c) for c in customers.columns])
    poorer = richest.withColumn("c_acctbal", F.col("c_acctbal") - 20000)
    batch = poorer.unionByName(customers.join(richest.select("c_custkey"), "c_custkey", "left_anti").select(*customers.columns))
    done = group_state.merge(spark, table, state, batch, ["c_custkey"], "c_nationkey", "c_acctbal", "nation_max")
    counts = [F.lit(getattr(done, name)).cast("long").alias(name) for name in ("inserted", "updated", "groups_moved", "rows_moved")]
    return tables.read_current(spark, table).select("c_custkey", "c_nationkey", "c_acctbal", "nation_max", *counts)


@_register(_MERGE_SQL + "SELECT o_orderkey, o_orderstatus, o_totalprice FROM matched")
def delta_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged rows, for a target that is a DataFrame."""
    orders = _table(spark, sf_dir, "orders")
    target = with_keys(_merge_target(orders), ["o_orderkey"])
    batch = with_keys(_merge_batch(orders), ["o_orderkey"])
    merged, _ = merge_plan(target, batch, ["o_orderkey"])
    return merged.select("o_orderkey", "o_orderstatus", "o_totalprice")


@_register("""
    SELECT count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS inserted, 0::bigint AS updated,
           0::bigint AS unchanged, 0::bigint AS rows_rewritten, count(*) AS rows
    FROM orders
""")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of new rows leaves all others as they lie."""
    orders = with_keys(_table(spark, sf_dir, "orders"), ["o_orderkey"])
    path, new = scratch_path(spark, "table"), F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")
    tables.overwrite(orders.where(~new), path, ROW_KEY, 8)
    merged = apply_merge(spark, path, orders.where(new), ["o_orderkey"])
    rows = tables.read_current(spark, path).agg(F.count(F.lit(1)).alias("rows"))
    return _counts(spark, merged).withColumn("rows_rewritten", F.lit(merged.rows_rewritten).cast("long")).join(rows)


@_register("""
    SELECT l_orderkey, l_linenumber,
           max(l_quantity) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_quantity
    FROM lineitem
""")
def merge_repeated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table that holds keys several times: none of their rows is lost."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = _table(spark, sf_dir, "lineitem").select(*keys, "l_quantity")
    path = scratch_path(spark, "table")
    tables.overwrite(with_keys(lines, keys), path, ROW_KEY, 8)
    largest = lines.groupBy(*keys).agg(F.max("l_quantity").alias("l_quantity"))
    apply_merge(spark, path, with_keys(largest, keys), keys)
    return tables.read_current(spark, path).select(*keys, "l_quantity")


@_register(_MERGE_SQL + """
    SELECT count(*) FILTER (action = 'insert') AS inserted,
           count(*) FILTER (action = 'update') AS updated,
           count(*) FILTER (action = 'unchanged') AS unchanged
    FROM matched
""")
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge into a stored table reports."""
    orders = _table(spark, sf_dir, "orders")
    path = scratch_path(spark, "table")
    tables.overwrite(with_keys(_merge_target(orders), ["o_orderkey"]), path, ROW_KEY, 8)
    merged = apply_merge(spark, path, with_keys(_merge_batch(orders), ["o_orderkey"]), ["o_orderkey"])
    return _counts(spark, merged)


@_register(_MERGE_SQL + "SELECT o_orderkey, action FROM matched WHERE action <> 'keep'")
def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge does with every incoming row."""
    orders = _table(spark, sf_dir, "orders")
    target = with_keys(_merge_target(orders), ["o_orderkey"])
    batch = stage_source(with_keys(_merge_batch(orders), ["o_orderkey"]), ["o_orderkey"])
    return classify(target, batch, ["o_orderkey"]).select("o_orderkey", "action")


@_register(_MERGE_SQL + "SELECT o_orderkey, o_orderstatus, o_totalprice FROM matched")
def streamed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge, fed by landing files as they arrive."""
    orders = _table(spark, sf_dir, "orders")
    spec = loads.LoadSpec(
        schema=orders.schema, keys=("o_orderkey",), group="o_custkey", value="o_orderdate",
        group_max="last_order", buckets=8,
    )
    table, landing, state = (scratch_path(spark, label) for label in ("table", "landing", "state"))
    loads.initial_load(_merge_target(orders), table, spec)
    _merge_batch(orders).write.options(**CSV_FORMAT).csv(landing)
    merge_new_files(spark, landing, table, state, spec).awaitTermination()
    return tables.read_current(spark, table).select("o_orderkey", "o_orderstatus", "o_totalprice")


@_register("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           CASE WHEN l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1999-01-01' THEN 0.0 ELSE l_quantity END AS l_quantity
    FROM lineitem
""")
def composite_key_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge on five key columns: lines shipped since 1999 arrive again, the
    returned ones without a quantity, together with lines the table lacks."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = _table(spark, sf_dir, "lineitem")
    recent = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp")
    quantity = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity"))
    path = scratch_path(spark, "table")
    tables.overwrite(with_keys(lines.where(~recent | (F.col("l_linestatus") == "O")), keys), path, ROW_KEY, 8)
    apply_merge(spark, path, with_keys(lines.where(recent).withColumn("l_quantity", quantity), keys), keys)
    return tables.read_current(spark, path).select(*keys, "l_quantity")


@_register("""
    SELECT 'first' AS run, count(*) FILTER (c_acctbal >= 0) AS inserted, 0::bigint AS updated,
           count(*) FILTER (c_acctbal < 0) AS unchanged
    FROM customer
    UNION ALL
    SELECT 'again', 0::bigint, 0::bigint, count(*) FROM customer
""")
def merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge applied twice: the second time nothing changes."""
    customers = with_keys(_table(spark, sf_dir, "customer"), ["c_custkey"])
    path = scratch_path(spark, "table")
    tables.overwrite(customers.where("c_acctbal < 0"), path, ROW_KEY, 8)
    first = apply_merge(spark, path, customers, ["c_custkey"])
    again = apply_merge(spark, path, customers, ["c_custkey"])
    return _counts(spark, first, "first").unionByName(_counts(spark, again, "again"))


@_register("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def source_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a merge would refuse."""
    return duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_register("""
    WITH tops AS (SELECT c_nationkey, max(c_acctbal) AS top FROM customer GROUP BY ALL)
    SELECT c.c_nationkey, count(*) AS n_rows,
           CASE WHEN any_value(n.n_regionkey) = 2 THEN count(*) ELSE 0 END AS n_marked
    FROM customer c JOIN tops t USING (c_nationkey) JOIN nation n ON n.n_nationkey = c.c_nationkey
    GROUP BY c.c_nationkey
""")
def group_change_marks_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A higher group maximum changes the hash of every row of the group: here
    the top balance of each nation of region 2 grows by one."""
    customers = _table(spark, sf_dir, "customer")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    tagged = group_max(customers, "c_nationkey", "c_acctbal", "top").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    grows = (F.col("c_acctbal") == F.col("top")) & (F.col("n_regionkey") == 2)
    raised = tagged.withColumn(
        "c_acctbal", F.when(grows, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    ).select(*customers.columns)
    keys = ["c_custkey"]
    before = enrich(customers, keys, "c_nationkey", "c_acctbal", "nation_max")
    after = enrich(raised, keys, "c_nationkey", "c_acctbal", "nation_max")
    pairs = before.join(after.select("c_custkey", F.col(ROW_HASH).alias("new_hash")), "c_custkey")
    return pairs.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(ROW_HASH) != F.col("new_hash")).alias("n_marked"),
    )


# --- Documents and vectors --------------------------------------------------------

_CUSTOMER_SENTENCE = (
    "The customer is", "{c_name}",
    ". Comes from", "{n_name}",
    ". Trades in", "{c_mktsegment}",
    ". Holds", "{balance}",
    "dollars.",
)

_CUSTOMER_DOCS_SQL = """
    SELECT c_custkey AS doc_key,
           concat_ws(' ', 'The customer is', c_name, '. Comes from', n_name, '. Trades in',
                     c_mktsegment, '. Holds', (c_acctbal::decimal(18,2))::varchar, 'dollars.') AS document
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return customers.withColumn("balance", _money("c_acctbal")).select(
        F.col("c_custkey").alias("doc_key"), sentence(_CUSTOMER_SENTENCE).alias("document")
    )


def _word_counts_sql(name: str, key: str, source: str, text: str, dim: int = VECTOR_DIM) -> str:
    """CTEs ``<name>_tf`` (key, bucket, tf) and ``<name>_norm`` (key, norm) of the
    word-count vectors of a text column."""
    return f"""
    {name}_words AS (
        SELECT {key}, unnest(string_split(
            translate(lower({text}), chr(9) || chr(10) || chr(13), '   '), ' ')) AS word FROM {source}),
    {name}_tf AS (
        SELECT {key}, ('0x' || substr(md5(word), 1, 8))::bigint % {dim} AS bucket, count(*)::double AS tf
        FROM {name}_words WHERE word <> '' GROUP BY ALL),
    {name}_norm AS (SELECT {key}, sqrt(sum(tf * tf)) AS norm FROM {name}_tf GROUP BY ALL)"""


_SIMILARITY_SQL = """
    dots AS (SELECT qid, doc_key, sum(q.tf * d.tf) AS dot
             FROM question_tf q JOIN doc_tf d USING (bucket) GROUP BY ALL),
    scored AS (SELECT q.qid, d.doc_key, round(coalesce(dot, 0) / (d.norm * q.norm), 12) AS similarity
               FROM question_norm q CROSS JOIN doc_norm d LEFT JOIN dots USING (qid, doc_key))"""


@_register(_CUSTOMER_DOCS_SQL)
def build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sentence per row."""
    return _customer_documents(spark, sf_dir)


@_register(f"""
    WITH {_word_counts_sql("doc", "doc_id", "documents", "text")}
    SELECT doc_id, bucket, tf FROM doc_tf
""")
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of whole texts, shown by their elements other than zero."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = embed_distinct(documents, "text", "vector")
    element = F.posexplode("vector").alias("bucket", "tf")
    found = vectors.select("doc_id", element).where("tf <> 0")
    return found.select("doc_id", F.col("bucket").cast("long"), F.col("tf").cast("double"))


@_register(f"""
    WITH docs AS ({_CUSTOMER_DOCS_SQL}), {_word_counts_sql("doc", "doc_key", "docs", "document")},
    sizes AS (SELECT doc_key, count(*) AS n_buckets, sum(tf) AS n_words FROM doc_tf GROUP BY ALL)
    SELECT c_custkey, nation_max, document, n_buckets, n_words
    FROM (SELECT c_custkey, max(c_acctbal) OVER (PARTITION BY c_nationkey) AS nation_max FROM customer)
    JOIN docs ON doc_key = c_custkey JOIN sizes USING (doc_key)
""")
def build_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and vectors of a stored table, written to a second one."""
    customers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    customers = customers.withColumn("balance", _money("c_acctbal"))
    spec = loads.LoadSpec(
        keys=("c_custkey",), group="c_nationkey", value="c_acctbal", group_max="nation_max",
        sentence=[p.replace("{balance}", "{shown}") for p in _CUSTOMER_SENTENCE], buckets=8,
    )
    customers = customers.withColumn("shown", F.col("balance").cast("string"))
    raw, out = scratch_path(spark, "table"), scratch_path(spark, "table")
    loads.initial_load(customers, raw, spec)
    loads.build_vectors(tables.read_current(spark, raw), out, spec)
    return tables.read_current(spark, out).select(
        "c_custkey",
        "nation_max",
        F.col("player_document").alias("document"),
        F.size(F.filter("player_vector", lambda x: x != 0)).cast("long").alias("n_buckets"),
        F.aggregate("player_vector", F.lit(0.0), lambda s, x: s + x).alias("n_words"),
    )


_REFRESH_SQL = """
    WITH joined AS (
        SELECT c_custkey, c_name, n_name, c_mktsegment, c_acctbal::decimal(18,2) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
    newer AS (
        SELECT c_custkey, c_name, n_name, c_mktsegment,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN balance + 1 ELSE balance END AS balance FROM joined),
    before AS (SELECT c_custkey, concat_ws(' ', 'A customer of', n_name, 'trades in', c_mktsegment, 'and holds',
                      floor(balance / 100)::bigint::varchar, 'hundred') AS document, balance FROM joined WHERE balance >= 0),
    after AS (SELECT c_custkey, concat_ws(' ', 'A customer of', n_name, 'trades in', c_mktsegment, 'and holds',
                     floor(balance / 100)::bigint::varchar, 'hundred') AS document, balance FROM newer),
    counts AS (
        SELECT (SELECT count(DISTINCT document) FROM before) AS first_texts,
               (SELECT count(DISTINCT document) FROM after WHERE document NOT IN (SELECT document FROM before)) AS new_texts,
               (SELECT count(*) FROM after a LEFT JOIN before b USING (c_custkey) WHERE b.c_custkey IS NULL) AS inserted,
               (SELECT count(*) FROM after a JOIN before b USING (c_custkey) WHERE a.balance <> b.balance) AS updated)
"""


@_register(_REFRESH_SQL + f""",
    {_word_counts_sql("doc", "c_custkey", "after", "document")},
    sizes AS (SELECT c_custkey, count(*) AS n_buckets, sum(tf) AS n_words FROM doc_tf GROUP BY ALL)
    SELECT c_custkey, document, n_buckets, n_words, first_texts, new_texts, inserted, updated
    FROM after JOIN sizes USING (c_custkey) CROSS JOIN counts
""")
def refresh_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector table brought up to date: customers with a negative balance arrive, and
    those in machinery get one more dollar; the model is given new sentences only."""
    customers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_name", "n_name", "c_mktsegment", "c_nationkey", _money("c_acctbal").alias("balance"))
    grown = customers.withColumn("balance", F.when(F.col("c_mktsegment") == "MACHINERY", F.col("balance") + 1).otherwise(F.col("balance")).cast("decimal(18,2)"))
    spec = loads.LoadSpec(
        keys=("c_custkey",), sentence=("A customer of", "{n_name}", "trades in", "{c_mktsegment}", "and holds", "{hundreds}", "hundred"),
        buckets=8)
    raw = lambda df: with_keys(df.withColumn("hundreds", F.floor(F.col("balance") / 100).cast("string")), ["c_custkey"])
    table, store = scratch_path(spark, "table"), scratch_path(spark, "vectors")
    first = loads.refresh_vectors(raw(customers.where("balance >= 0")), table, store, "words-1", spec)
    later = loads.refresh_vectors(raw(grown), table, store, "words-1", spec)
    number = lambda n: F.lit(n).cast("long")
    return tables.read_current(spark, table).select(
        "c_custkey", F.col("player_document").alias("document"),
        F.size(F.filter("player_vector", lambda x: x != 0)).cast("long").alias("n_buckets"),
        F.aggregate("player_vector", F.lit(0.0), lambda s, x: s + x).alias("n_words"),
        number(first.embedded).alias("first_texts"), number(later.embedded).alias("new_texts"),
        number(later.merged.inserted).alias("inserted"), number(later.merged.updated).alias("updated"))


@_register("""
    SELECT vec_id, len(embedding) AS n_elements,
           round(list_sum(list_transform(embedding, lambda x: x::double)), 6) AS total
    FROM embeddings
""")
def vector_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors to JSON text and back, with the length checked."""
    texts = _table(spark, sf_dir, "embeddings").select("vec_id", to_json_text(F.col("embedding")).alias("json"))
    vectors = texts.select("vec_id", check_dim(to_vector(F.col("json")), 64).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    return vectors.select(
        "vec_id", F.size("v").cast("long").alias("n_elements"), F.round(total, 6).alias("total")
    )


# --- Retrieval --------------------------------------------------------------------


_TOPK_SQL = """
    WITH pairs AS (
        SELECT q.vec_id AS qid, d.vec_id AS doc_key,
               round(list_cosine_similarity(q.embedding::double[], d.embedding::double[]), 12) AS s
        FROM embeddings q CROSS JOIN embeddings d),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, doc_key) AS rank FROM pairs)
    SELECT qid, doc_key, round(s, 6) AS similarity, rank::bigint AS rank FROM ranked WHERE rank <= 3
"""


@_register(_TOPK_SQL)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector search over all vectors, for each of them."""
    vectors = _table(spark, sf_dir, "embeddings")
    docs = vectors.select(F.col("vec_id").alias("doc_key"), F.col("embedding").alias("vector"))
    asked = vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("question_vector"))
    found = search.vector_topk(docs, asked, 3)
    return found.withColumn("similarity", F.round("similarity", 6))


@_register(_TOPK_SQL)
def bounded_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search, scheduled by the executors: cells and rings of documents meet the
    blocks of questions that may need them."""
    vectors = _table(spark, sf_dir, "embeddings")
    docs = vectors.select(F.col("vec_id").alias("doc_key"), F.col("embedding").alias("vector"))
    asked = vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("question_vector"))
    return search.bounded_topk(docs, asked, 3).withColumn("similarity", F.round("similarity", 6))


@_register(f"""
    WITH docs AS (SELECT min(doc_id) AS doc_key, text AS document FROM documents GROUP BY text),
    questions AS (SELECT doc_key AS qid, document AS question FROM docs),
    {_word_counts_sql("doc", "doc_key", "docs", "document")},
    {_word_counts_sql("question", "qid", "questions", "question")},
    {_SIMILARITY_SQL},
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, doc_key) AS rank FROM scored)
    SELECT qid, doc_key, round(similarity, 6) AS similarity, rank FROM ranked WHERE rank <= 5
""")
def distinct_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search over whole texts, each text found once, for each different text."""
    documents = _table(spark, sf_dir, "documents")
    texts = documents.select(F.col("doc_id").alias("doc_key"), F.col("text").alias("document"))
    docs = stage(embed(search.one_per_document(texts), "document", "vector"), "texts").df
    asked = docs.select(F.col("doc_key").alias("qid"), F.col("vector").alias("question_vector"))
    return search.vector_topk(docs, asked, 5).withColumn("similarity", F.round("similarity", 6))


_ONE_QUESTION = "Which customer from NATION_7 trades in machinery and holds 100.00 dollars?"


@_register(f"""
    WITH docs AS ({_CUSTOMER_DOCS_SQL}),
    question AS (SELECT 0 AS qid, '{_ONE_QUESTION}' AS question),
    {_word_counts_sql("doc", "doc_key", "docs", "document")},
    {_word_counts_sql("question", "qid", "question", "question")},
    {_SIMILARITY_SQL}
    SELECT doc_key, document, round(similarity, 6) AS similarity
    FROM scored JOIN docs USING (doc_key)
    WHERE document ILIKE '%nation_7%' AND document ILIKE '%machinery%'
    ORDER BY scored.similarity DESC, doc_key LIMIT 5
""")
def nearest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid search for one question."""
    docs = embed(_customer_documents(spark, sf_dir), "document", "vector")
    question = HashingEmbedder().encode([_ONE_QUESTION])[0]
    found = search.nearest(docs, question, 5, ["nation_7", "machinery"])
    return found.withColumn("similarity", F.round("similarity", 6))


@_register("""
    SELECT doc_id, lang, source FROM documents
    WHERE text ILIKE '%é%' AND text ILIKE '%on_e%' AND text ILIKE '%THE%'
""")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that hold every one of some keywords."""
    wanted = contains_all(F.col("text"), ["é", "on_e", "T'HE"])
    return _table(spark, sf_dir, "documents").where(wanted).select("doc_id", "lang", "source")


@_register("""
    SELECT doc_id, lang, source, 'plain' AS kind FROM documents
    WHERE text ILIKE '%é%' AND text ILIKE '%tion%' AND text ILIKE '%THE%'
    UNION ALL
    SELECT doc_id, lang, source, 'wildcards' FROM documents WHERE text ILIKE '%der%und_die%'
""")
def indexed_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter over stored groups, of which only those with the keywords' trigrams
    are read."""
    docs, path = _table(spark, sf_dir, "documents"), scratch_path(spark, "indexed")
    keyword_index.build(docs, path, 32, ["lang", "source", "doc_id"], "text")
    plain = keyword_index.find(spark, path, ["é", "TION", "T'HE"], text="text").df
    wild = keyword_index.find(spark, path, ["der%und_die"], text="text").df
    columns = ("doc_id", "lang", "source")
    return plain.select(*columns, F.lit("plain").alias("kind")).unionByName(
        wild.select(*columns, F.lit("wildcards").alias("kind")))


@_register(f"""
    WITH docs AS ({_CUSTOMER_DOCS_SQL})
    SELECT n_nationkey AS qid, count(doc_key) AS matches FROM nation LEFT JOIN docs
    ON document ILIKE concat('%', n_name, '%') AND document ILIKE '%household%'
    GROUP BY n_nationkey
    UNION ALL
    SELECT 100 + r_regionkey, count(doc_key) FROM region LEFT JOIN docs
    ON document ILIKE concat('%', r_name, '%')
    GROUP BY r_regionkey
""")
def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords from a table of questions: how many documents hold those of each."""
    nations = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("qid"), F.array("n_name", F.lit("household")).alias("hard_keywords")
    )
    regions = _table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 100).alias("qid"), F.array("r_name").alias("hard_keywords")
    )
    return search.keyword_counts(_customer_documents(spark, sf_dir), nations.unionByName(regions))


# Questions about every nation and region. Regions do not occur in the documents.
_QUESTIONS_SQL = """
    SELECT n_nationkey::bigint AS qid,
           concat('Which machinery customers from ', n_name, ' hold many dollars?') AS question,
           ['MACHINERY', n_name] AS kws, 'Which customers from hold many dollars' AS semantic
    FROM nation
    UNION ALL
    SELECT 100 + r_regionkey::bigint, concat('Which customers from ', r_name, ' hold many dollars?'),
           [r_name], 'Which customers from hold many dollars'
    FROM region
"""

_HYBRID_SQL = f"""
    WITH docs AS ({_CUSTOMER_DOCS_SQL}), questions AS ({_QUESTIONS_SQL}),
    {_word_counts_sql("doc", "doc_key", "docs", "document")},
    {_word_counts_sql("question", "qid", "questions", "semantic")},
    {_SIMILARITY_SQL},
    ranked AS (
        SELECT qid, doc_key, document, similarity,
               row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, doc_key) AS rank
        FROM scored JOIN docs USING (doc_key) JOIN questions USING (qid)
        WHERE len(list_filter(kws, lambda k: document ILIKE concat('%', k, '%'))) = len(kws)),
    found AS (SELECT * FROM ranked WHERE rank <= 5),
    contexts AS (
        SELECT qid, string_agg(document, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context,
               count(*) AS matches
        FROM found GROUP BY qid)
"""


def _filtered_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    terms = filters.vocabulary(nations, ["n_name"]).union(filters.vocabulary(regions, ["r_name"]))
    terms = terms.union(filters.vocabulary(_table(spark, sf_dir, "customer"), ["c_mktsegment"]))
    asked = nations.select(
        F.col("n_nationkey").cast("long").alias("qid"),
        F.concat(F.lit("Which machinery customers from "), "n_name", F.lit(" hold many dollars?")).alias("question"),
    ).unionByName(
        regions.select(
            (F.col("r_regionkey") + 100).cast("long").alias("qid"),
            F.concat(F.lit("Which customers from "), "r_name", F.lit(" hold many dollars?")).alias("question"),
        )
    )
    return filters.extract_filters(asked, terms)


def _hybrid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    asked = _filtered_questions(spark, sf_dir)
    return asked, answering.hybrid_retrieval(_customer_documents(spark, sf_dir), asked)


@_register(_HYBRID_SQL + "SELECT qid, doc_key, round(similarity, 6) AS similarity, rank, document FROM found")
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path: filters from the question, keyword filter, top-k by vector."""
    _, found = _hybrid(spark, sf_dir)
    return found.withColumn("similarity", F.round("similarity", 6))


@_register(_HYBRID_SQL + "SELECT qid, context, matches FROM contexts")
def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found documents of each question in rank order, as one text."""
    _, found = _hybrid(spark, sf_dir)
    return answers.contexts(found)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompt_sql(template: str) -> str:
    before, rest = template.split("{context}")
    between, after = rest.split("{question}")
    return f"{_quoted(before)} || context || {_quoted(between)} || question || {_quoted(after)}"


@_register(_HYBRID_SQL + f"""
    SELECT qid, CASE WHEN matches IS NULL THEN 'no_match' ELSE 'ok' END AS status,
           coalesce(matches, 0) AS matches, {_prompt_sql(HYBRID.prompt)} AS prompt
    FROM questions LEFT JOIN contexts USING (qid)
""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts, and questions without a match."""
    asked, found = _hybrid(spark, sf_dir)
    return answering.answer(asked, found).select("qid", "status", "matches", "prompt")


@_register(_HYBRID_SQL + f"""
    SELECT qid, CASE WHEN matches IS NULL THEN 'no_match' ELSE 'ok' END AS status,
           CASE WHEN matches IS NULL THEN {_quoted(HYBRID.no_match)}
                ELSE length({_prompt_sql(HYBRID.prompt)}) || ' characters read' END AS answer
    FROM questions LEFT JOIN contexts USING (qid)
""")
def hybrid_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers through a generator, or the text that stands for them."""
    asked, found = _hybrid(spark, sf_dir)
    return answering.answer(asked, found, answers.PromptLength).select("qid", "status", "answer")


@_register("""
    WITH questions AS (
        SELECT c_custkey AS qid,
               concat('What does ', c_name, ' of ', n_name, ', ', r_name, ' pay for "', c_mktsegment, '"?') AS question,
               list_sort([n_name, r_name, c_mktsegment]) AS kws, concat('What does ', c_name, ' of pay for') AS semantic
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT qid, question, array_to_string(kws, '|') AS keywords, semantic AS semantic_query FROM questions
""")
def extract_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of many questions, by a vocabulary; some terms have two words."""
    people = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    asked = people.select(
        F.col("c_custkey").alias("qid"),
        F.format_string('What does %s of %s, %s pay for "%s"?', "c_name", "n_name", "r_name", "c_mktsegment").alias("question"),
    )
    terms = filters.vocabulary(people, ["n_name", "r_name", "c_mktsegment"])
    found = filters.extract_filters(asked, terms)
    return found.select("qid", "question", F.array_join("hard_keywords", "|").alias("keywords"), "semantic_query")


@_register("""
    SELECT c_custkey AS qid, array_to_string(list_sort([concat(n_name, ' ', r_name), c_mktsegment]), '|') AS keywords,
           concat('Does ', c_name, ' of trade in') AS semantic_query
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def longest_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of many questions where terms share words: only the leftmost, longest count."""
    people = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("place", F.concat_ws(" ", "n_name", "r_name"))
    )
    asked = people.select(
        F.col("c_custkey").alias("qid"),
        F.format_string("Does %s of %s trade in %s?", "c_name", "place", "c_mktsegment").alias("question"),
    )
    known = filters.vocabulary(people, ["n_name", "r_name", "place", "c_mktsegment"])
    found = filters.extract_filters(asked, known, overlaps=LONGEST)
    return found.select("qid", F.array_join("hard_keywords", "|").alias("keywords"), "semantic_query")


@_register("""
    SELECT concat('n', c_custkey) AS id, 'ok' AS status, c_mktsegment AS keyword, c_name AS semantic_query
    FROM customer
    UNION ALL
    SELECT concat('e', event_id), 'bad_filters', NULL, NULL FROM events
""")
def parse_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters as JSON text, with and without the required fields."""
    whole = _table(spark, sf_dir, "customer").select(
        F.concat(F.lit("n"), "c_custkey").alias("id"),
        F.to_json(
            F.struct(F.array("c_mktsegment").alias("hard_keywords"), F.col("c_name").alias("semantic_query"))
        ).alias("response"),
    )
    other = _table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), "event_id").alias("id"), F.col("props").alias("response")
    )
    parsed = filters.parse_filters(whole.unionByName(other))
    return parsed.select("id", "status", F.get("hard_keywords", F.lit(0)).alias("keyword"), "semantic_query")


@_register("""
    SELECT c_custkey AS qid,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'bad_filters' ELSE 'ok' END AS status,
           CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_mktsegment END AS keyword
    FROM customer
""")
def requested_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters by a remote client that fails on some questions: an error, text that
    is no JSON, and a NULL keyword cost one question each."""

    class Client:
        def extract(self, prompt: str) -> str:
            name, segment = prompt.split('Query: "')[1].split('"')[0].rsplit(" ", 1)
            if segment == "BUILDING":
                raise ConnectionError(name)
            if segment == "MACHINERY":
                return "no filters found"
            words = [segment, None] if segment == "HOUSEHOLD" else [segment]
            return json.dumps({"hard_keywords": words, "semantic_query": name})

    asked = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("qid"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("question")
    )
    responses = stage(filters.request_filters(asked, Client), "responses").df
    keyword = F.when(F.col("status") == filters.OK, F.get("hard_keywords", F.lit(0)))
    return filters.parse_filters(responses).select("qid", "status", keyword.alias("keyword"))


_ASKED_SQL = """
    WITH asked AS (
        SELECT o_orderkey AS qid, concat('Which orders of customer ', o_custkey, ' are ', o_orderpriority, '?') AS prompt,
               o_orderpriority <> '1-URGENT' AS first_run
        FROM orders),
    counts AS (
        SELECT count(DISTINCT prompt) AS prompts, count(DISTINCT prompt) FILTER (first_run) AS first_answers FROM asked)
"""


@_register(_ASKED_SQL + """
    SELECT qid, first_run, concat(length(prompt), ' characters read') AS answer, prompts, first_answers,
           prompts - first_answers AS first_failures, first_answers AS later_known,
           prompts - first_answers AS later_answers
    FROM asked CROSS JOIN counts
""")
def resumed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers through a ledger: a first run whose model refuses some prompts, and a second
    one that asks only these."""

    class Refuses(answers.PromptLength):
        def generate(self, prompt: str) -> str:
            if "1-URGENT" in prompt:
                raise ConnectionError(prompt)
            return super().generate(prompt)

    prompt = F.concat(F.lit("Which orders of customer "), "o_custkey", F.lit(" are "), "o_orderpriority", F.lit("?"))
    asked = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("qid"), prompt.alias("prompt"), F.lit(filters.OK).alias("status")
    )
    kept, how = scratch_path(spark, "ledger"), {"retries": ledger.Retries(2, 0.0), "buckets": 8}
    first, tried = ledger.generate_kept(asked, kept, "length-1", Refuses, **how)
    first = stage(first.select("qid", (F.col("status") == filters.OK).alias("first_run")), "first").df
    later, again = ledger.generate_kept(asked, kept, "length-1", answers.PromptLength, **how)
    number = lambda n: F.lit(n).cast("long")
    return later.join(first, "qid").select(
        "qid", "first_run", "answer", number(tried.prompts).alias("prompts"),
        number(tried.answered).alias("first_answers"), number(tried.failed).alias("first_failures"),
        number(again.known).alias("later_known"), number(again.answered).alias("later_answers"))


# --- Vector-only answers and transcripts -------------------------------------------

_TRANSCRIPT_SQL = f"""
    WITH docs AS (SELECT item_id AS doc_key, text AS document FROM benchmark),
    questions AS (
        SELECT conv_id || '/' || turn AS qid, conv_id, turn, text AS question
        FROM conversations WHERE role = 'user'),
    {_word_counts_sql("doc", "doc_key", "docs", "document")},
    {_word_counts_sql("question", "qid", "questions", "question")},
    {_SIMILARITY_SQL},
    ranked AS (
        SELECT qid, document,
               row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, doc_key) AS rank
        FROM scored JOIN docs USING (doc_key)),
    contexts AS (
        SELECT qid, string_agg(document, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
        FROM ranked WHERE rank <= 3 GROUP BY qid),
    answers AS (
        SELECT conv_id, turn, question,
               CASE WHEN context IS NULL THEN {_quoted(VECTOR_ONLY.no_match)}
                    ELSE length({_prompt_sql(VECTOR_ONLY.prompt)}) || ' characters read' END AS answer
        FROM questions LEFT JOIN contexts USING (qid))
"""


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("doc_key"), F.col("text").alias("document")
    )
    docs = embed(passages, "document", "vector")
    asked = answering.user_questions(_table(spark, sf_dir, "conversations"))
    return answering.answer_by_vector(docs, asked, answers.PromptLength)


@_register(_TRANSCRIPT_SQL + "SELECT conv_id, turn, question, answer FROM answers")
def vector_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn answered by vector search alone."""
    return _chat(spark, sf_dir).select("conv_id", "turn", "question", "answer")


@_register(_TRANSCRIPT_SQL + f"""
    SELECT DISTINCT conv_id, 0::bigint AS turn, 'assistant' AS role, {_quoted(GREETING)} AS text FROM answers
    UNION ALL SELECT conv_id, 2 * turn + 1, 'user', question FROM answers
    UNION ALL SELECT conv_id, 2 * turn + 2, 'assistant', answer FROM answers
""")
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greeting, questions and answers of every conversation."""
    return answering.transcripts(_chat(spark, sf_dir))
