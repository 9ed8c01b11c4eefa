"""Group maxima kept up to date, against taking them over the whole table."""

import random

import pytest

from factloom.operators import group_state
from factloom.operators.enrich import enrich
from factloom.sources import tables

SCHEMA = "id int, g string, v int, p string"


class Case:
    def __init__(self, spark, folder, rows):
        self.spark, self.table, self.state, self.rows = spark, str(folder / "t"), str(folder / "s"), {r[0]: r for r in rows}
        start = spark.createDataFrame(rows, SCHEMA)
        tables.overwrite(enrich(start, ["id"], "g", "v", "top"), self.table, "row_sk", 4)
        group_state.build(start, self.state, "g", "v", 2)

    def merge(self, batch):
        before = self.tops()
        old = dict(self.rows)
        done = group_state.merge(self.spark, self.table, self.state, self.spark.createDataFrame(batch, SCHEMA), ["id"], "g", "v", "top")
        self.rows |= {r[0]: r for r in batch}
        tops = self.tops()
        expected = enrich(self.spark.createDataFrame(list(self.rows.values()), SCHEMA), ["id"], "g", "v", "top")
        got = {tuple(r) for r in tables.read_current(self.spark, self.table).select(expected.columns).collect()}
        assert got == {tuple(r) for r in expected.collect()}
        counts = {(r["group_key"], r["top"], r["at_top"]) for r in tables.read_current(self.spark, self.state).where("at_top > 0").collect()}
        assert counts == {(g, t, sum(r[1] == g and r[2] == t for r in self.rows.values())) for g, t in tops.items()}
        changed = {r[0] for r in batch if old.get(r[0]) != r}
        moved = {g for g in {*tops, *before} if before.get(g) != tops.get(g)}
        assert (done.inserted + done.updated, done.groups_moved) == (len(changed), len(moved))
        assert done.rows_moved == sum(r[1] in moved and i not in changed for i, r in self.rows.items())
        return done

    def tops(self):
        groups = {r[1] for r in self.rows.values()}
        return {g: max((r[2] for r in self.rows.values() if r[1] == g and r[2] is not None), default=None) for g in groups}


START = [(1, "a", 5, "x"), (2, "a", 5, "x"), (3, "a", 3, "x"), (4, "b", 1, "x"), (5, None, 2, "x"), (6, "c", None, "x"), (7, "d", 9, "x")]


@pytest.mark.parametrize("batch,rescanned", [
    ([(3, "a", 4, "x")], 0),  # below the maximum
    ([(3, "a", 7, "x"), (8, "a", 1, "x")], 0),  # a new maximum
    ([(1, "a", 2, "x")], 0),  # one of two rows at the maximum
    ([(1, "a", 2, "x"), (2, "a", 1, "x")], 1),  # both of them
    ([(4, "a", 9, "x")], 1),  # from one group to another, which leaves none
    ([(5, None, 8, "x"), (6, "c", 4, "x"), (9, "new", None, "x")], 0),
    ([(1, "a", 5, "other"), (2, "a", 5, "x")], 0),  # only payload differs
    ([(7, "d", None, "x")], 1),
])
def test_single_batches(spark, tmp_path, batch, rescanned):
    assert Case(spark, tmp_path, START).merge(batch).groups_rescanned == rescanned


def test_many_batches_in_turn(spark, tmp_path):
    draw = random.Random(4)
    one = lambda i: (i, draw.choice("abc"), draw.choice([None, *range(6)]), draw.choice("xy"))
    case = Case(spark, tmp_path, [one(i) for i in range(30)])
    for _ in range(3):
        case.merge([one(i) for i in draw.sample(range(45), 8)])


def test_the_same_batch_twice_moves_nothing(spark, tmp_path):
    case = Case(spark, tmp_path, START)
    case.merge([(1, "a", 50, "x"), (8, "z", 1, "x")])
    again = case.merge([(1, "a", 50, "x"), (8, "z", 1, "x")])
    assert (again.inserted, again.updated, again.unchanged, again.rows_moved) == (0, 0, 2, 0)
