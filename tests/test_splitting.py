"""CSV files read in byte ranges, and types of texts."""

import random

import pytest
from pyspark.sql import types as T

from factloom.sources import inference, splitting
from factloom.sources.landing import read_landing

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("x", T.StringType())])
FIELDS = ["", "plain", '"quoted"', '"a,b"', '"line\nbreak"', '"say ""hi"""', '"\n\n"', '""', '"""\n"""', '"ends with\n"', '5" pipe', 'x"y"z', "é漢", '" blank "']


@pytest.fixture
def ranges_of(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def use(size):
        for name, value in zip(names, (size, "1", "1")):
            spark.conf.set(name, value)

    yield use
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())


def both(spark, path):
    read = lambda split: sorted(map(tuple, read_landing(spark, str(path), SCHEMA, split=split).collect()), key=repr)
    return read(True), read(False)


@pytest.mark.parametrize("seed,size,end", [(1, "33", "\n"), (2, "47", "\n"), (3, "61", "\r\n"), (5, "1m", "\r\n")])
def test_like_one_task_per_file(spark, tmp_path, ranges_of, seed, size, end):
    draw = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        rows = [f"{i},{draw.choice(FIELDS)},{draw.choice(FIELDS)}" for i in range(14)]
        write(tmp_path / "in", name, "id,text,x\n".replace("\n", end) + "".join(r + end + (end if draw.random() < 0.1 else "") for r in rows))
    ranges_of(size)
    got, expected = both(spark, tmp_path / "in")
    assert got == expected and len(got) == 28


def test_a_record_over_many_ranges_and_a_header_cut_by_one(spark, tmp_path, ranges_of):
    long = "\n".join(f"line {i} with ""quotes""" for i in range(60))
    write(tmp_path / "in", "a.csv", f'id,"text",x\n1,"{long}",a\n2,b,"{long}"\n3,c,d')
    ranges_of("150")
    got, expected = both(spark, tmp_path / "in")
    assert got == expected and len(got) == 3


def test_one_file_is_read_by_many_tasks(spark, tmp_path, ranges_of):
    write(tmp_path / "in", "a.csv", "id,text,x\n" + "".join(f'{i},"a\nb",c\n' for i in range(2000)))
    ranges_of("2k")
    known = splitting.ranges(splitting._lines(spark, str(tmp_path / "in"), "*.csv"))
    assert known.rows > 8 and splitting._lines(spark, str(tmp_path / "in"), "*.csv").rdd.getNumPartitions() > 8
    assert read_landing(spark, str(tmp_path / "in"), SCHEMA, split=True).count() == 2000


def test_the_states_of_ranges_compose_when_shuffled(spark, tmp_path, ranges_of, monkeypatch):
    write(tmp_path / "in", "a.csv", "id,text,x\n" + "".join(f'{i},"a\n""b\n",c\n' for i in range(60)))
    ranges_of("60")
    monkeypatch.setattr("factloom.sources.staging.BROADCAST_BYTES", 0)
    got, expected = both(spark, tmp_path / "in")
    assert got == expected


def test_headers_must_agree(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "id,text,x\n1,a,b\n")
    write(tmp_path / "in", "b.csv", "id,x,text\n1,a,b\n")
    with pytest.raises(ValueError, match="header"):
        read_landing(spark, str(tmp_path / "in"), SCHEMA, split=True).collect()


def test_only_a_header(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "id,text,x\n")
    got, expected = both(spark, tmp_path / "in")
    assert got == expected == []


@pytest.mark.parametrize("line,outside,inside", [
    ("plain", False, True), ('a,"b', True, False), ('"a"', False, False), ('a"', False, False), ('x,5" y', False, False), ('""', False, True),
    ('"""', True, False), ('","', False, True), ("", False, True), ('a,"",b', False, True)])
def test_ends_inside(line, outside, inside):
    assert splitting.ends_inside(line, False) == outside
    assert splitting.ends_inside(line, True) == inside


COLUMNS = {
    "small": (["1", "-20", None], "int"), "large": (["1", "12345678901"], "bigint"), "huge": (["1", "1234567890123456789012"], "decimal(22,0)"),
    "share": (["0.25", "0.5", None], "decimal(2,2)"), "mixed": (["100", "0.125"], "decimal(6,3)"), "signed": (["+1.5", "-2"], "decimal(2,1)"),
    "day": (["2024-02-29", "1999-12-31"], "date"), "no_day": (["2023-02-29", "1999-12-31"], "string"), "time": (["2024-01-01 10:00:00.5", "2024-01-02"], "timestamp_ntz"),
    "truth": (["true", "FALSE"], "boolean"), "code": (["007", "12"], "string"), "text": (["1", "a"], "string"), "none": ([None, None], "string"),
    "power": (["1e5", "2"], "string"), "zero": (["0", "0.0"], "decimal(1,1)"),
}


def test_types_are_exact_and_widen(spark):
    for name, (values, expected) in COLUMNS.items():
        rows = spark.createDataFrame([(v,) for v in values], "c string")
        (field,) = inference.infer(rows).fields
        assert field.dataType.simpleString() == expected, name
    rows = spark.createDataFrame([(v,) for v in ("0.25", "1")], "c string")
    (field,) = inference.infer(rows).fields
    assert [str(r[0]) for r in rows.select(inference.convert(rows.c, field.dataType)).collect()] == ["0.25", "1.00"]


def test_inferred_landing_files(spark, tmp_path):
    write(tmp_path / "in", "a.csv", 'id,a b,x.y\n1,0.25,"2024-01-01"\n2,12,"2024-01-02"\n')
    rows = read_landing(spark, str(tmp_path / "in"), None, split=True)
    assert [f.dataType.simpleString() for f in rows.schema] == ["int", "decimal(4,2)", "date"]
    assert rows.columns == ["id", "a b", "x.y"] and rows.count() == 2


def test_files_without_quotes_do_not_go_to_python(spark, tmp_path, ranges_of, monkeypatch):
    """Next to a file with quotes; an empty first line, and lines that look like the header, stay what they are."""
    write(tmp_path / "in", "a.csv", "id,text,x\n" + "".join(f"{i},t{i},\n\n" for i in range(40)) + "9,last,x")
    write(tmp_path / "in", "b.csv", "id,text,x\r\n" + "".join(f"{i},u{i},id\r\n" for i in range(40)))
    ranges_of("64")
    got, expected = both(spark, tmp_path / "in")
    assert got == expected and len(got) == 81
    with monkeypatch.context() as m:
        m.setattr(splitting, "_records", None)
        assert both(spark, tmp_path / "in")[0] == expected
    write(tmp_path / "in", "c.csv", 'id,text,x\n1,"a\nb",c\n')
    got, expected = both(spark, tmp_path / "in")
    assert got == expected and len(got) == 82


def test_a_task_reads_many_ranges(spark, tmp_path, ranges_of, monkeypatch):
    monkeypatch.setattr(splitting, "TASKS", 1, raising=False)
    write(tmp_path / "in", "a.csv", "id,text,x\n" + "".join(f'{i},"a\nb",c\n' for i in range(2000)))
    ranges_of("256")
    found = splitting.records(spark, str(tmp_path / "in"))
    assert found.count() == 2001 and found.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
