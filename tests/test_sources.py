"""Landing files and schemas."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.schemas import FILTERS, RAW, SRC, VEC, conform
from factloom.sources import tables
from factloom.sources.landing import read_landing

SMALL = T.StructType(
    [
        T.StructField("player_id", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("age", T.IntegerType()),
    ]
)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def add(name, text):
        (folder / name).write_text(text, encoding="utf-8")
        return str(folder)

    return add


def test_quoted_and_empty_fields(spark, landing):
    path = landing("a.csv", 'player_id,player_name,age\nP1,"O\'Brien, J",22\nP2,"says ""hi""\nthere", \nP3,  x ,\n')
    rows = [tuple(r) for r in read_landing(spark, path, SMALL).collect()]
    assert rows[0] == ("P1", "O'Brien, J", 22)
    assert rows[1][:2] == ("P2", 'says "hi"\nthere')
    assert rows[2] == ("P3", "  x ", None)


def test_all_files_of_a_folder(spark, landing):
    landing("a.csv", "player_id,player_name,age\nP1,a,1\n")
    landing("note.txt", "not a csv")
    path = landing("b.csv", "player_id,player_name,age\nP2,b,2\n")
    rows = read_landing(spark, path, SMALL, file_column="file").collect()
    assert {(r.player_id, r.file.rsplit("/", 1)[1]) for r in rows} == {("P1", "a.csv"), ("P2", "b.csv")}


def test_inferred_schema(spark, landing):
    path = landing("a.csv", "id,x,day\n1,0.25,2026-06-11\n")
    df = read_landing(spark, path, schema=None)
    assert dict(df.dtypes) == {"id": "int", "x": "double", "day": "date"}


def test_single_line_files_can_be_split(spark, landing):
    path = landing("a.csv", "player_id,player_name,age\nP1,a,1\nP2,b,2\n")
    assert read_landing(spark, path, SMALL, multi_line=False).count() == 2


def test_empty_folder_fails(spark, landing):
    with pytest.raises(FileNotFoundError):
        read_landing(spark, landing("a.txt", "x"), SMALL)


def test_schemas():
    assert (len(SRC.fields), len(RAW.fields), len(VEC.fields)) == (75, 78, 80)
    assert len({f.name.lower() for f in VEC.fields}) == 80
    decimals = [f.name for f in RAW.fields if isinstance(f.dataType, T.DecimalType)]
    assert len(decimals) == 18
    assert all(isinstance(VEC[name].dataType, T.DoubleType) for name in decimals)
    assert [f.name for f in FILTERS.fields] == ["hard_keywords", "semantic_query"]


def test_conform_binds_by_name(spark):
    df = spark.createDataFrame([(7, "P1", "x")], "age long, player_id string, player_name string")
    assert conform(df, SMALL).schema == SMALL and conform(df, SMALL).first() == ("P1", "x", 7)


def test_rating_boundary(spark):
    schema = T.StructType([T.StructField("r", T.DecimalType(2, 1))])
    fits = spark.createDataFrame([(Decimal("9.9"),)], "r decimal(3,1)")
    assert conform(fits, schema).first().r == Decimal("9.9")
    over = spark.createDataFrame([(Decimal("10.0"),)], "r decimal(3,1)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        conform(over, schema).select(F.max("r")).collect()


def test_columns_are_bound_by_name(spark, landing):
    path = landing("a.csv", "age,more,player_name,player_id\n22,z,Jo,P1\n")
    df = read_landing(spark, path, SMALL, file_column="file")
    assert df.columns == ["player_id", "player_name", "age", "file"]
    assert tuple(df.drop("file").first()) == ("P1", "Jo", 22)
    with pytest.raises(ValueError, match="age"):
        read_landing(spark, landing("b.csv", "player_id,player_name\nP1,Jo\n").replace("a.csv", ""), SMALL, pattern="b.csv")


def test_differing_headers_and_bad_values_fail(spark, landing):
    landing("a.csv", "player_id,player_name,age\nP1,Jo,oops\n")
    path = landing("b.csv", "player_name,player_id,age\nJo,P1,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, path, SMALL).collect()
    assert read_landing(spark, path, SMALL, pattern="a.csv").first().age is None
    with pytest.raises(Exception, match="(?i)malformed"):
        read_landing(spark, path, SMALL, pattern="a.csv", mode="FAILFAST").collect()
    assert read_landing(spark, path, SMALL, pattern="b.csv").first().player_name == "Jo"


def test_header_without_rows(spark, landing):
    df = read_landing(spark, landing("a.csv", "player_id,player_name,age\n"), SMALL)
    assert df.count() == 0 and df.schema == SMALL


def test_rows_are_counted_from_footers(spark, table):
    rows = spark.range(1000).withColumn("row_sk", F.col("id") % 7)
    tables.overwrite(rows, table, "row_sk", 4)
    tables.append(rows.where("id < 10"), table, "row_sk")
    expected = {b: tables.read_current(spark, table, [b]).count() for b in range(4)}
    assert tables.stored_row_counts(spark, {"t": table}) == {"t": expected}
    # A bucket that a merge rewrites counts once.
    tables.replace_buckets(rows.where("row_sk = 1"), rows.where("id < 0"), table, "row_sk")
    changed = {b: tables.read_current(spark, table, [b]).count() for b in range(4)}
    assert tables.stored_row_counts(spark, {"t": table})["t"] == changed != expected
    plan = tables.footer_counts(spark, table)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)" in plan or "PushedAggregation: [COUNT(1)" in plan, plan
    assert "id#" not in plan.split("== Physical Plan ==")[1]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_an_empty_table_counts_nothing(spark, table):
    tables.create_or_replace(spark, table, T.StructType([T.StructField("row_sk", T.LongType())]), 4)
    assert tables.stored_row_counts(spark, {"t": table}) == {"t": {}}
    assert tables.stored_row_counts(spark, {}) == {}


def test_a_table_is_written_by_bucket_without_sorting_its_rows(spark, table, monkeypatch):
    """A sort holds all rows of a task: vectors that are small in a shuffle are large there."""
    from pyspark.sql import functions as F

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name), []
    rows = spark.range(0, 4000, 1, 2).select(F.col("id").alias("row_sk"), F.array_repeat(F.lit(0.0), 768).alias("v"))
    plain = type(rows.write).parquet
    monkeypatch.setattr(type(rows.write), "parquet", lambda *a, **k: (seen.append(int(spark.conf.get(name))), plain(*a, **k))[1])
    assert tables.overwrite(rows, table, "row_sk", 8) == 4000
    assert seen and min(seen) >= 8 and spark.conf.get(name) == before
    assert tables.read_current(spark, table).count() == 4000
