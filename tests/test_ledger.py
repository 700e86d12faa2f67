"""The ledger of checksums: files are hashed once, changed ones again."""

import hashlib
import os

import pytest

from mapstrata.sources import ledger, manifest


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a", "one"), ("b", "two"), ("c", "")):
        (tmp_path / "in" / f"{name}.gpkg").write_text(text)
    (tmp_path / "in" / "note.txt").write_text("other")
    return tmp_path / "in"


def found(spark, folder, database):
    rows = ledger.checksums(spark, str(folder), f"{database}.ledger").collect()
    return {os.path.basename(r.path): (r.length, r.md5, r.hashed) for r in rows}


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_files_are_hashed_once(spark, folder, database):
    first = {"a.gpkg": (3, md5("one"), True), "b.gpkg": (3, md5("two"), True)}
    assert found(spark, folder, database) == first
    again = {name: (n, digest, False) for name, (n, digest, _) in first.items()}
    entered = spark.table(f"{database}.ledger").count()
    files = ledger.landed(spark, str(folder))
    assert ledger.unknown(files, ledger.entries(spark, f"{database}.ledger")).count() == 0
    assert found(spark, folder, database) == again
    spark.catalog.refreshTable(f"{database}.ledger")
    assert spark.table(f"{database}.ledger").count() == entered == 2


def test_changed_and_new_files(spark, folder, database):
    found(spark, folder, database)
    (folder / "a.gpkg").write_text("ONE")
    os.utime(folder / "a.gpkg", (2_000_000_000, 2_000_000_000))
    (folder / "d.gpkg").write_text("four")
    (folder / "b.gpkg").unlink()
    assert found(spark, folder, database) == {
        "a.gpkg": (3, md5("ONE"), True), "d.gpkg": (4, md5("four"), True)
    }
    assert spark.table(f"{database}.ledger").count() == 4
    assert ledger.compact(spark, str(folder), f"{database}.ledger") == 2
    assert spark.table(f"{database}.ledger").count() == 2
    assert not any(hashed for _, _, hashed in found(spark, folder, database).values())


def test_stale_sources_of_several_files(spark):
    expected = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "x")], "k int, expected_md5 string")
    actual = spark.createDataFrame(
        [(1, 3, "y"), (1, 3, "x"), (2, 3, "y"), (3, 3, "z"), (5, 0, "x")], "k int, length long, md5 string"
    )
    assert sorted(r.k for r in manifest.to_fetch(expected, actual, ["k"]).collect()) == [2, 4, 5]
