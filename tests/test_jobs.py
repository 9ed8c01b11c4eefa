"""Whole jobs on player-match rows, and the registered queries."""

import csv
import datetime
import os
import subprocess
import sys

import pytest
from pyspark.sql import types as T

import __spark_entry__ as registry
from factloom.operators.embed import HashingEmbedder
from factloom.plans.answering import documents_of, hybrid_retrieval
from factloom.plans.loads import LoadSpec, run
from factloom.schemas import RAW, SRC, VEC
from factloom.sources import tables
from factloom.streaming.landing import merge_new_files
from tools.check import TABLES, compare

SPEC = LoadSpec(buckets=4)


def player_rows(count, **fixed):
    """Rows of the landing file with plausible values for every column."""
    for i in range(count):
        row = {}
        for field in SRC.fields:
            if isinstance(field.dataType, T.StringType):
                row[field.name] = f"{field.name} {i % 5}"
            elif isinstance(field.dataType, T.DateType):
                row[field.name] = datetime.date(2026, 6, 11 + i % 10).isoformat()
            elif isinstance(field.dataType, T.DecimalType):
                row[field.name] = "0.5"
            else:
                row[field.name] = i
        yield row | {"player_name": f"Player {i % 6}", "match_id": f"M{i}", "team": f"Team {i % 2}", "total_goals_tournament": i % 6, "total_minutes_tournament": 90} | fixed


def write_landing(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as file:
        writer = csv.DictWriter(file, [f.name for f in SRC.fields])
        writer.writeheader()
        writer.writerows(rows)


def test_run_from_landing_to_retrieval(spark, tmp_path):
    landing, raw, vectors = (str(tmp_path / n) for n in ("landing", "raw", "vectors"))
    write_landing(landing, "a.csv", player_rows(30, position="Forward"))
    result = run(spark, landing, raw, vectors, SPEC)
    assert (result.loaded, result.documents) == (30, 30)
    # Both loads read the same files, so the merge changes nothing.
    assert (result.merged.inserted, result.merged.updated, result.merged.unchanged) == (0, 0, 30)
    stored = tables.read_current(spark, raw)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in RAW]
    table = tables.read_current(spark, vectors)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in VEC]
    assert {r.team: r.Team_Max_Goals for r in table.collect()} == {"Team 0": 28, "Team 1": 29}
    assert all(len(r.player_vector) == 768 for r in table.select("player_vector").collect())
    asked = spark.createDataFrame([(1, ["team 1"], "player is Player 3")], "qid long, hard_keywords array<string>, semantic_query string")
    found = hybrid_retrieval(documents_of(table), asked).orderBy("rank").collect()
    assert len(found) == 5 and all("Team 1" in r.document and "Player 3" in r.document for r in found)
    once = hybrid_retrieval(documents_of(table), asked, distinct_documents=True).collect()
    assert len({r.document for r in once}) == len(once) == 3


def test_new_files_are_merged_as_they_arrive(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    tables.create_or_replace(spark, table, RAW, 4)
    results = []

    def merge():
        query = merge_new_files(spark, landing, table, state, SPEC, on_merge=lambda _, r: results.append(r))
        query.awaitTermination()

    write_landing(landing, "a.csv", player_rows(10))
    merge()
    write_landing(landing, "b.csv", player_rows(12, age=40))
    merge()
    merge()
    assert [(r.inserted, r.updated) for r in results] == [(10, 0), (2, 10)]
    assert tables.read_current(spark, table).where("age = 40").count() == 12


def test_bad_values_end_a_load(spark, tmp_path):
    landing, raw, vectors = (str(tmp_path / n) for n in ("landing", "raw", "vectors"))
    write_landing(landing, "a.csv", player_rows(3, age="old"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        run(spark, landing, raw, vectors, SPEC)
    loose = LoadSpec(buckets=4, mode="PERMISSIVE", pattern="a*.csv")
    write_landing(landing, "b.csv", player_rows(3))
    assert run(spark, landing, raw, vectors, loose).loaded == 3
    assert tables.read_current(spark, raw).where("age IS NULL").count() == 3


def test_embedder_is_a_parameter(spark, tmp_path):
    landing, raw, vectors = (str(tmp_path / n) for n in ("landing", "raw", "vectors"))
    write_landing(landing, "a.csv", player_rows(3))
    run(spark, landing, raw, vectors, SPEC, lambda: HashingEmbedder(4))
    assert len(tables.read_current(spark, vectors).first().player_vector) == 4


def test_entry(spark):
    found = registry.entry(spark)
    assert found.columns == ["qid", "doc_key", "similarity", "rank", "document"] and found.count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{registry.SMOKE_DIR}/{table}.parquet'")
    ours = registry.queries()[name](spark, registry.SMOKE_DIR).toArrow()
    assert compare(ours, database.sql(registry.oracle_sql()[name]).to_arrow_table()) == "equal"


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from factloom.session import local_session\n"
        "import __spark_entry__ as registry\n"
        "assert registry.entry(local_session('2', 2)).count() > 0\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=300)
