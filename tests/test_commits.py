"""Replacing departments in one commit: kills between steps, recovery, sweeping, twins."""

import os

import pytest
from pyspark.sql import functions as F

from mapstrata.operators import commits, dedup, tables


def rows(spark, spec):
    """spec: department -> values."""
    found = [(f"{d}-{v}", v, d) for d, values in spec.items() for v in values]
    return spark.createDataFrame(found, "cleabs string, v int, dept string")


@pytest.fixture
def table(spark, database):
    name = f"{database}.t_batiment"
    first = rows(spark, {"D001": [1, 2], "D002": [3], "D003": [4, 5]})
    tables.ensure_table(spark, name, first.schema, "batiment")
    tables.append(first, name)
    return name


def held(spark, name):
    found = {}
    for r in spark.table(name).orderBy("v").collect():
        found.setdefault(r.dept, []).append(r.v)
    return found


OLD = {"D001": [1, 2], "D002": [3], "D003": [4, 5]}
NEW = {"D001": [10], "D003": [4, 5], "D004": [40]}


class Killed(Exception):
    pass


def test_replaces_in_one_commit(spark, table):
    done = commits.replace_departments(rows(spark, {"D001": [10], "D004": [40]}), table, ["D001", "D002", "D004", "D009"])
    assert (done.rows, done.rows_by_dept) == (2, {"D001": 1, "D002": 0, "D004": 1, "D009": 0})
    assert held(spark, table) == NEW and commits.pending(spark, table) == {}
    # Only the files of rows that are there remain.
    root = commits.table_location(spark, table).removeprefix("file:")
    assert not os.path.exists(f"{root}/dept=D001") and not os.path.exists(f"{root}/dept=D002")
    again = commits.replace_departments(rows(spark, {"D001": [11]}), table, ["D001"])
    assert again.rows == 1 and held(spark, table)["D001"] == [11]
    tables.append(rows(spark, {"D001": [12]}), table)
    assert held(spark, table)["D001"] == [11, 12]


@pytest.mark.parametrize("step", ["SET LOCATION", "ADD IF NOT EXISTS", "DROP IF EXISTS", "UNSET TBLPROPERTIES"])
def test_killed_after_the_commit(spark, table, monkeypatch, step):
    """Every department has its old or its new rows; the next writer finishes the commit."""
    original = type(spark).sql

    def dying(self, text, *args, **kwargs):
        if step in text:
            raise Killed(step)
        return original(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", dying)
    with pytest.raises(Killed):
        commits.replace_departments(rows(spark, {"D001": [10], "D004": [40]}), table, ["D001", "D002", "D004"])
    monkeypatch.undo()
    between = held(spark, table)
    for dept in ("D001", "D002", "D003", "D004"):
        assert between.get(dept) in (OLD.get(dept), NEW.get(dept))
    assert len(commits.pending(spark, table)) == 1
    commits.replace_departments(rows(spark, {"D005": [50]}), table, ["D005"])
    assert held(spark, table) == NEW | {"D005": [50]} and commits.pending(spark, table) == {}


def test_killed_before_the_commit(spark, table, monkeypatch):
    monkeypatch.setattr(commits, "announce", lambda *a: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        commits.replace_departments(rows(spark, {"D001": [10]}), table, ["D001", "D002"])
    monkeypatch.undo()
    assert held(spark, table) == OLD
    assert commits.sweep(spark, table) == []  # it could still be writing
    gone = commits.sweep(spark, table, hours=0)
    assert len(gone) == 1 and held(spark, table) == OLD and commits.sweep(spark, table, hours=0) == []


def test_sweep_keeps_what_is_used(spark, table):
    commits.replace_departments(rows(spark, {"D001": [10], "D004": [40]}), table, ["D001", "D004"])
    assert commits.sweep(spark, table, hours=0) == []
    commits.replace_departments(rows(spark, {"D001": [11], "D004": [41]}), table, ["D001", "D004"])
    assert len(commits.sweep(spark, table, hours=0)) == 1  # the emptied folder of the first run
    assert held(spark, table) == {"D001": [11], "D002": [3], "D003": [4, 5], "D004": [41]}


def test_commits_of_two_runs_follow_their_order(spark, table):
    for value in (10, 11):
        staged = commits.stage(rows(spark, {"D001": [value]}), table)
        commits.announce(spark, table, staged, ["D002"] if value == 10 else [])
    assert len(commits.pending(spark, table)) == 2 and held(spark, table) == OLD
    assert len(commits.recover(spark, table)) == 2
    assert held(spark, table) == {"D001": [11], "D003": [4, 5]} and commits.recover(spark, table) == []


def test_rows_without_department(spark, table):
    df = rows(spark, {"D001": [10]}).unionByName(rows(spark, {"x": [7]}).withColumn("dept", F.lit(None).cast("string")))
    commits.replace_departments(df, table, ["D001"])
    assert held(spark, table) == OLD | {"D001": [10], None: [7]}
    commits.replace_all(df.withColumn("v", F.col("v") + 1), table)
    assert held(spark, table) == {"D001": [11], None: [8]}


def test_nothing_to_write(spark, table):
    done = commits.replace_departments(rows(spark, {}), table, ["D001", "D002"])
    assert done.rows == 0 and held(spark, table) == {"D003": [4, 5]}


def test_a_table_without_departments(spark, database):
    name = f"{database}.t_links"
    first = spark.range(3).selectExpr("id AS cleabs")
    tables.ensure_table(spark, name, first.schema, "batiment_rnb_lien_bdtopo")
    tables.append(first, name)
    for n in (5, 2):
        assert commits.replace_all(spark.range(n).selectExpr("id AS cleabs"), name) == n
        assert spark.table(name).count() == n
    tables.append(first, name)
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_twin_is_old_or_new(spark, table, monkeypatch):
    twin = table + "_dedup"
    assert dedup.dedup_table(spark, table, twin).after == 5
    comment = tables.table_metadata(spark, twin).columns["cleabs"]
    tables.append(rows(spark, {"D009": [1, 2]}).withColumn("cleabs", F.lit("D001-1")), table)
    commits.replace_departments(rows(spark, {"D002": [30]}), table, ["D002", "D003"])
    with monkeypatch.context() as patch:
        patch.setattr(commits, "carry_out", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            dedup.dedup_table(spark, table, twin)
    assert held(spark, twin) == OLD
    commits.recover(spark, twin)
    assert held(spark, twin) == {"D001": [1, 2], "D002": [30]}
    assert tables.table_metadata(spark, twin).columns["cleabs"] == comment


def test_rows_without_key_may_stay(spark, table):
    no_key = rows(spark, {"D008": [1, 2, 3]}).withColumn("cleabs", F.lit(None).cast("string"))
    tables.append(no_key, table)
    for limit in (dedup.BROADCAST_BYTES, -1):
        dedup.BROADCAST_BYTES, before = limit, dedup.BROADCAST_BYTES
        try:
            kept = dedup.dedup_table(spark, table, table + "_a", null_key="keep")
            one = dedup.dedup_table(spark, table, table + "_b")
        finally:
            dedup.BROADCAST_BYTES = before
        assert (kept.before, kept.after, one.after) == (8, 8, 6)
        assert spark.table(table + "_a").count() == 8 and spark.table(table + "_b").count() == 6


def test_types_grow_wider(spark, table):
    new = spark.createDataFrame([("D001-9", 2**40, "D001")], "cleabs string, v long, dept string")
    root = commits.table_location(spark, table)
    done = commits.replace_departments(new, table, ["D001"])
    assert (done.rows, done.rows_by_dept) == (1, {"D001": 1})
    assert dict(spark.table(table).dtypes)["v"] == "bigint"
    assert held(spark, table) == OLD | {"D001": [2**40]}
    # Whole numbers of four bytes read as eight, so no other department was rewritten.
    assert os.path.exists(f"{root.removeprefix('file:')}/dept=D002")
    half = new.withColumn("v", F.lit(0.5)).withColumn("dept", F.lit("D002"))
    done = commits.replace_departments(half, table, ["D002", "D003"])
    assert done.rows_by_dept == {"D002": 1, "D003": 0} and done.rows == 1
    assert held(spark, table) == {"D001": [float(2**40)], "D002": [0.5]}


def test_texts_become_dates(spark, database):
    name = f"{database}.t_dates"
    first = spark.createDataFrame([("a", "2020-01-02", "D001"), ("b", "soon", "D002")], "cleabs string, d string, dept string")
    tables.append(first, name)
    dated = first.filter("dept = 'D001'").selectExpr("cleabs", "DATE'2021-05-06' AS d", "dept")
    commits.replace_departments(dated, name, ["D001"])
    assert dict(spark.table(name).dtypes)["d"] == "date"
    assert sorted((r.dept, str(r.d)) for r in spark.table(name).collect()) == [("D001", "2021-05-06"), ("D002", "None")]
    commits.replace_departments(first.filter("dept = 'D001'"), name, ["D001"])  # texts are read as dates
    assert [str(r.d) for r in spark.table(name).filter("dept = 'D001'").collect()] == ["2020-01-02"]


def test_killed_while_types_change(spark, table, monkeypatch):
    new = spark.createDataFrame([("D001-9", 1.5, "D001")], "cleabs string, v double, dept string")
    tables.append(rows(spark, {"D006": [2**30]}), table)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "carry_out", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            commits.replace_departments(new.withColumn("v", F.lit("x")), table, ["D001"])
    assert held(spark, table) == OLD | {"D006": [2**30]}
    assert commits.recover(spark, table) and dict(spark.table(table).dtypes)["v"] == "string"
    assert held(spark, table) == {"D001": ["x"], "D002": ["3"], "D003": ["4", "5"], "D006": [str(2**30)]}
