"""Hashes, group maximum, merge and tables."""

import pytest
from pyspark.sql import functions as F

from factloom.functions.hashing import with_keys
from factloom.operators.enrich import enrich, group_max
from factloom.operators.merge import DuplicateKeys, apply_merge, classify, merge_plan, stage_source
from factloom.plans.loads import LoadSpec, delta_load, initial_load
from factloom.schemas import RAW, ROW_HASH, ROW_KEY
from factloom.sources import staging, tables

SCHEMA = "name string, match string, team string, goals int"
KEYS = ["name", "match"]
SPEC = LoadSpec(keys=KEYS, group="team", value="goals", group_max="top", buckets=4)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, table, *columns):
    return sorted(map(tuple, tables.read_current(spark, table).select(*columns or ["name", "match", "goals"]).collect()), key=repr)


@pytest.fixture(params=["small batch", "large batch"])
def any_size(request, monkeypatch):
    """Run with the batch taken for small, and for too large to broadcast."""
    if request.param == "large batch":
        monkeypatch.setattr(staging, "BROADCAST_ROWS", -1)


def test_null_moved_between_columns_changes_the_hash(spark):
    df = spark.createDataFrame([("k", "a", None), ("k", None, "a"), ("k", None, None)], "k string, x string, y string")
    assert with_keys(df, ["k"]).select(ROW_HASH).distinct().count() == 3
    assert with_keys(df, ["x", "y"]).select(ROW_KEY).distinct().count() == 3


def test_hash_covers_every_column_but_the_key(spark):
    base = frame(spark, ("a", "1", "t", 1))
    one = with_keys(base, KEYS).first()
    for column, value in [("team", "u"), ("goals", 2)]:
        other = with_keys(base.withColumn(column, F.lit(value)), KEYS).first()
        assert other[ROW_KEY] == one[ROW_KEY] and other[ROW_HASH] != one[ROW_HASH]
    again = with_keys(with_keys(base, KEYS), KEYS).first()
    assert again == one


def test_group_max_with_nulls(spark, any_size):
    df = frame(spark, ("a", "1", "x", 1), ("b", "1", "x", 5), ("c", "1", None, 2), ("d", "1", None, 3), ("e", "1", "y", None))
    got = {r.name: r.top for r in group_max(df, "team", "goals", "top").collect()}
    assert got == {"a": 5, "b": 5, "c": 3, "d": 3, "e": None}


def test_group_max_does_not_shuffle_the_rows(spark, sf):
    plan = group_max(sf("lineitem"), "l_suppkey", "l_tax", "top")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_merge_inserts_updates_and_keeps(spark, table, any_size):
    old = frame(spark, ("a", "1", "x", 1), ("b", "1", "x", 2), ("c", "1", "x", 3), (None, "1", "x", 4))
    tables.overwrite(with_keys(old, KEYS), table, ROW_KEY, 4)
    new = frame(spark, ("a", "1", "x", 1), ("b", "1", "x", 9), ("d", "1", "x", 5), (None, "1", "x", 6), ("a", None, "x", 7))
    result = apply_merge(spark, table, with_keys(new, KEYS), KEYS)
    assert (result.inserted, result.updated, result.unchanged) == (2, 2, 1)
    assert content(spark, table) == sorted(
        [("a", "1", 1), ("b", "1", 9), ("c", "1", 3), (None, "1", 6), ("d", "1", 5), ("a", None, 7)], key=repr
    )
    again = apply_merge(spark, table, with_keys(new, KEYS), KEYS)
    assert (again.inserted, again.updated, again.unchanged, again.buckets_written) == (0, 0, 5, 0)
    actions = classify(with_keys(old, KEYS), stage_source(with_keys(new, KEYS), KEYS), KEYS)
    assert {(r.name, r.match): r.action for r in actions.collect()} == {
        ("a", "1"): "unchanged", ("b", "1"): "update", (None, "1"): "update", ("d", "1"): "insert", ("a", None): "insert",
    }


def test_merge_counts_add_up(spark, sf, any_size):
    orders = with_keys(sf("orders"), ["o_orderkey"])
    target = orders.where("o_orderpriority <> '1-URGENT'")
    changed = sf("orders").where("o_orderpriority <> '5-LOW'").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(F.col("o_totalprice"))
    )
    merged, result = merge_plan(target, with_keys(changed, ["o_orderkey"]), ["o_orderkey"])
    assert result.inserted + result.updated + result.unchanged == changed.count()
    assert merged.count() == target.count() + result.inserted == orders.count()
    assert merged.select("o_orderkey").distinct().count() == merged.count()


def test_merge_writes_only_buckets_with_changes(spark, sf, table):
    orders = with_keys(sf("orders"), ["o_orderkey"])
    tables.overwrite(orders, table, ROW_KEY, 16)
    one = sf("orders").where("o_orderkey = 7").withColumn("o_totalprice", F.lit(1.0))
    result = apply_merge(spark, table, with_keys(one, ["o_orderkey"]), ["o_orderkey"])
    assert (result.updated, result.buckets_written) == (1, 1)
    assert len(tables.glob(spark, f"{table}/snapshot=000002-delta-16/key_bucket=*")) == 1
    assert tables.read_current(spark, table).count() == orders.count()


def test_small_batch_leaves_the_target_unshuffled(spark, sf):
    target = with_keys(sf("orders"), ["o_orderkey"])
    staged = stage_source(target.limit(5), ["o_orderkey"])
    plan = classify(target, staged, ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    target_side = plan[plan.index("LeftSemi") :]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in target_side


def test_duplicate_source_keys_fail_or_are_reduced(spark, table):
    tables.overwrite(with_keys(frame(spark, ("a", "1", "x", 1)), KEYS), table, ROW_KEY, 4)
    twice = with_keys(frame(spark, ("a", "1", "x", 2), ("a", "1", "x", 3), ("b", "1", "x", 4), ("b", "1", "x", 4)), KEYS)
    with pytest.raises(DuplicateKeys, match="name='a'"):
        apply_merge(spark, table, twice, KEYS)
    assert content(spark, table) == [("a", "1", 1)]
    result = apply_merge(spark, table, twice, KEYS, dedupe_by="goals")
    assert (result.inserted, result.updated) == (1, 1)
    assert content(spark, table) == [("a", "1", 3), ("b", "1", 4)]


def test_new_group_maximum_marks_the_whole_group(spark, table):
    rows = [("a", "1", "x", 1), ("b", "1", "x", 2), ("c", "1", "y", 3)]
    initial_load(frame(spark, *rows), table, SPEC)
    rows[1] = ("b", "1", "x", 8)
    result = delta_load(frame(spark, *rows), table, SPEC)
    assert (result.inserted, result.updated, result.unchanged) == (0, 2, 1)
    assert content(spark, table, "name", "top") == [("a", 8), ("b", 8), ("c", 3)]


def test_group_maximum_of_a_partial_delta(spark, sf, tmp_path):
    for recompute, expected in [(False, [("a", 9), ("b", 9), ("c", 5)]), (True, [("a", 9), ("b", 9), ("c", 9)])]:
        table = str(tmp_path / str(recompute))
        initial_load(frame(spark, ("a", "1", "x", 9), ("b", "1", "x", 2)), table, SPEC)
        delta_load(frame(spark, ("c", "1", "x", 5)), table, SPEC, recompute_group_measures=recompute)
        assert content(spark, table, "name", "top") == expected
    replay = delta_load(tables.read_current(spark, table).select(*KEYS, "team", "goals"), table, SPEC)
    assert (replay.inserted, replay.updated) == (0, 0)


def test_unfinished_snapshot_is_ignored(spark, table):
    initial_load(frame(spark, ("a", "1", "x", 1)), table, SPEC)
    frame(spark, ("z", "9", "x", 1)).write.parquet(f"{table}/snapshot=000002-delta-4/key_bucket=0")
    assert content(spark, table) == [("a", "1", 1)]
    delta_load(frame(spark, ("b", "1", "x", 1)), table, SPEC)
    assert content(spark, table) == [("a", "1", 1), ("b", "1", 1)]


def test_superseded_snapshots_are_dropped(spark, table):
    initial_load(frame(spark, ("a", "1", "x", 1)), table, SPEC)
    delta_load(frame(spark, ("b", "1", "x", 2)), table, SPEC)
    assert tables.drop_superseded(spark, table) == 0
    tables.overwrite(tables.read_current(spark, table), table, ROW_KEY, 4)
    delta_load(frame(spark, ("c", "1", "x", 3)), table, SPEC)
    assert tables.drop_superseded(spark, table) == 2
    assert content(spark, table) == [("a", "1", 1), ("b", "1", 2), ("c", "1", 3)]


def test_create_or_replace_gives_an_empty_table(spark, table):
    assert not tables.exists(spark, table)
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, table)
    tables.create_or_replace(spark, table, RAW, 4)
    empty = tables.read_current(spark, table)
    assert empty.count() == 0 and [f.name for f in empty.schema] == [f.name for f in RAW]


def test_merge_into_an_empty_table(spark, table):
    source = enrich(frame(spark, ("a", "1", "x", 1)), KEYS, "team", "goals", "top")
    tables.create_or_replace(spark, table, source.schema, 4)
    assert apply_merge(spark, table, source, KEYS).inserted == 1
    assert content(spark, table) == [("a", "1", 1)]


def test_namespaces(spark):
    tables.create_namespaces(spark, ["raw_data", "util"])
    tables.create_namespaces(spark, ["util"])
    assert {"raw_data", "util"} <= {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}


def test_stage_measures(spark):
    staged = staging.stage(frame(spark, ("a", "1", "x", 1), ("bb", "1", None, 2)), "t", {"most": F.max("goals")})
    assert (staged.rows, staged.metrics) == (2, {"most": 2}) and staged.bytes >= 6
    assert staging.stage(frame(spark).limit(0), "t").rows == 0


def test_repeated_target_keys_lose_no_row(spark, table, any_size):
    old = frame(spark, ("a", "1", "x", 1), ("a", "1", "x", 2), ("b", "1", "x", 1), ("b", "1", "x", 2), ("c", "1", "x", 5), ("c", "1", "x", 5))
    new = frame(spark, ("a", "1", "x", 1), ("b", "1", "x", 9), ("c", "1", "x", 5))
    tables.overwrite(with_keys(old, KEYS), table, ROW_KEY, 4)
    result = apply_merge(spark, table, with_keys(new, KEYS), KEYS)
    assert (result.inserted, result.updated, result.unchanged) == (0, 2, 1)
    wanted = [("a", "1", 1)] * 2 + [("b", "1", 9)] * 2 + [("c", "1", 5)] * 2
    assert content(spark, table) == wanted
    merged, counts = merge_plan(with_keys(old, KEYS), with_keys(new, KEYS), KEYS)
    assert sorted(map(tuple, merged.select("name", "match", "goals").collect())) == wanted
    assert counts.unchanged == 1


def test_inserts_rewrite_nothing(spark, sf, table):
    orders = with_keys(sf("orders"), ["o_orderkey"])
    old, new = orders.where("o_orderkey % 10 > 0"), orders.where("o_orderkey % 10 = 0")
    tables.overwrite(old, table, ROW_KEY, 8)
    result = apply_merge(spark, table, new, ["o_orderkey"])
    assert (result.inserted, result.rows_rewritten, result.buckets_written) == (new.count(), 0, 0)
    again = apply_merge(spark, table, orders.withColumn(ROW_HASH, F.lit(-1).cast("long")), ["o_orderkey"])
    assert (again.updated, again.rows_rewritten) == (orders.count(), orders.count())
    assert tables.read_current(spark, table).count() == orders.count()


def test_overwrite_with_no_rows_gives_an_empty_table(spark, table):
    source = enrich(frame(spark, ("a", "1", "x", 1)), KEYS, "team", "goals", "top")
    assert tables.overwrite(source.limit(0), table, ROW_KEY, 4) == 0
    assert tables.read_current(spark, table).columns == source.columns and not content(spark, table)
    assert apply_merge(spark, table, source, KEYS).inserted == 1
    assert content(spark, table) == [("a", "1", 1)]


@pytest.fixture(params=[("BROADCAST_BYTES", -1), ("BROADCAST_ROWS", 3), ("BROADCAST_ROWS", -1)], ids=str)
def any_large_batch(request, monkeypatch):
    """Batches too large to broadcast: their updates sent at once, in rounds, or not at all."""
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(staging, *request.param)


def test_large_batch_replaces_rows_with_null_and_repeated_keys(spark, table, any_large_batch):
    names = [*"abcdefghij", None]
    old = [(n, m, "t", 1) for n in names for m in ("1", None)]
    tables.overwrite(with_keys(frame(spark, *old, old[0], old[0], old[-1]), KEYS), table, ROW_KEY, 4)
    new = [(n, m, "t", 2) for n in ("a", "c", "e", "g", None) for m in ("1", None)] + [("b", "1", "t", 1), ("z", None, "t", 3)]
    got = apply_merge(spark, table, with_keys(frame(spark, *new), KEYS), KEYS)
    assert (got.inserted, got.updated, got.unchanged) == (1, 10, 1)
    now = {(n, m): g for n, m, _, g in [*old, *new]}
    copies = [("a", "1", 2)] * 2 + [(None, None, 2)]
    assert content(spark, table) == sorted([(*k, g) for k, g in now.items()] + copies, key=repr)
    base, _ = tables._live_buckets(spark, table)
    later = [s for s in tables._complete_snapshots(spark, table) if s > base]
    assert [s.rsplit("-", 2)[1] for s in later] == ["delta", "append"]
    assert got.rows_rewritten == sum(
        spark.read.parquet(folder).count() for folder in tables.glob(spark, f"{later[0]}/{tables.BUCKET}=*"))


def test_rows_of_one_surrogate_key_are_told_apart_by_their_key(spark, table, any_large_batch):
    same = lambda rows: with_keys(rows, KEYS).withColumn(ROW_KEY, F.lit(5).cast("long"))
    tables.overwrite(same(frame(spark, ("a", "1", "t", 1), ("b", "1", "t", 1), ("c", "1", "t", 1))), table, ROW_KEY, 4)
    got = apply_merge(spark, table, same(frame(spark, ("a", "1", "t", 2), ("d", "1", "t", 2))), KEYS)
    assert (got.inserted, got.updated) == (1, 1)
    assert content(spark, table) == [("a", "1", 2), ("b", "1", 1), ("c", "1", 1), ("d", "1", 2)]


def test_unfinished_rounds_are_ignored(spark, table, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(staging, "BROADCAST_ROWS", 1)
    rows = frame(spark, *[(n, "1", "t", 1) for n in "abcdefghijklmnop"])
    tables.overwrite(with_keys(rows, KEYS), table, ROW_KEY, 4)
    newer, write = with_keys(rows.withColumn("goals", F.lit(2)), KEYS), tables._write_buckets

    def stopped(df, target, last=True):
        if last:
            raise RuntimeError("stopped")
        return write(df, target, last)

    monkeypatch.setattr(tables, "_write_buckets", stopped)
    with pytest.raises(RuntimeError):
        apply_merge(spark, table, newer, KEYS)
    assert {g for _, _, g in content(spark, table)} == {1}
    monkeypatch.setattr(tables, "_write_buckets", write)
    assert apply_merge(spark, table, newer, KEYS).updated == 16
    assert content(spark, table) == [(n, "1", 2) for n in "abcdefghijklmnop"]


def test_target_is_shuffled_once_to_classify_a_large_batch(spark, sf, monkeypatch):
    lines, keys = sf("lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rows = with_keys(lines, keys)
    source = stage_source(rows, keys)
    monkeypatch.setattr(staging, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = classify(rows, source, keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_large_batch_leaves_rows_without_an_update_where_they_lie(spark, sf, table, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    customers = with_keys(sf("customer"), ["c_custkey"])
    tables.overwrite(customers, table, ROW_KEY, 4)
    newer = with_keys(sf("customer").where("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(0.0)), ["c_custkey"])
    plans, write = [], tables._write_buckets

    def seen(df, *args, **named):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **named)

    monkeypatch.setattr(tables, "_write_buckets", seen)
    assert apply_merge(spark, table, newer, ["c_custkey"]).updated == newer.count()
    [plan] = plans
    # The rebalance is below the union, on the side of what is replaced.
    assert plan.index("Union") < plan.index("RebalancePartitions") and "LeftSemi" in plan
