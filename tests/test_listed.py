"""Tables as lists of files and the ledger of ingested files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from skyfare.sources import lake, ledger, listed

ROWS = "k BIGINT, v BIGINT, s STRING"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def names(spark, path, version=None):
    return {r.file for r in listed.listed_files(spark, path, version).collect()}


@pytest.fixture()
def table(spark, tmp_dir):
    """Ten files of ten keys each."""
    path = os.path.join(tmp_dir, "table")
    for i in range(10):
        df = spark.range(10 * i, 10 * i + 10, 1, 1).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"),
                                                           F.lit("a").alias("s"))
        df.write.parquet(f"{path}/data/b{i}")
    files = [(os.path.join(f"b{i}", f),) for i in range(10) for f in os.listdir(f"{path}/data/b{i}") if f.startswith("part")]
    listed.commit(spark, path, spark.createDataFrame(files, "file STRING"))
    return path


def test_one_changed_key_rewrites_one_file(spark, table):
    before = names(spark, table)
    changes = spark.createDataFrame([(37, 5, "new")], ROWS)
    assert listed.upsert_listed(spark, table, changes, ["k"], "v") == 1
    after = names(spark, table)
    gone = before - after
    assert len(before) == 10 and len(gone) == 1 and gone.pop().startswith("b3/")
    want = lake.upsert_rows(listed.read_listed(spark, table, 0), changes, ["k"], "v")
    assert rows(listed.read_listed(spark, table)) == rows(want)
    assert listed.delete_listed(spark, table, spark.createDataFrame([(90,), (91,)], "k BIGINT"), ["k"]) == 2
    assert len(after - names(spark, table)) == 1
    assert {r.k for r in listed.read_listed(spark, table).collect()} == set(range(100)) - {90, 91}
    assert listed.read_listed(spark, table, 0).count() == 100  # versions before stay readable


def test_keys_of_no_file(spark, table):
    before = names(spark, table)
    assert listed.delete_listed(spark, table, spark.createDataFrame([(1000,), (None,)], "k BIGINT"), ["k"]) == 0
    listed.upsert_listed(spark, table, spark.createDataFrame([(1000, 1, "x"), (None, 1, "y")], ROWS), ["k"], "v")
    assert before < names(spark, table) and listed.read_listed(spark, table).count() == 102
    listed.delete_listed(spark, table, spark.createDataFrame([(None,)], "k BIGINT"), ["k"])
    assert listed.read_listed(spark, table).count() == 101


def test_all_rows_deleted_leaves_an_empty_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    listed.create_listed(spark, path, spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], ROWS))
    listed.delete_listed(spark, path, spark.createDataFrame([(1,)], "k BIGINT"), ["k"])
    assert listed.read_listed(spark, path).columns == ["k", "v", "s"] and listed.read_listed(spark, path).count() == 0
    listed.upsert_listed(spark, path, spark.createDataFrame([(2, 1, "a")], ROWS), ["k"], "v")
    assert rows(listed.read_listed(spark, path)) == [(2, 1, "a")]
    with pytest.raises(FileExistsError):
        listed.create_listed(spark, path, spark.createDataFrame([], ROWS))
    with pytest.raises(FileNotFoundError):
        listed.read_listed(spark, os.path.join(tmp_dir, "none"))


def test_a_list_that_was_cut_off_does_not_count(spark, table, monkeypatch):
    real = listed.commit
    def dies(spark, path, files, sources=None):
        os.makedirs(f"{path}/lists/0000000001")
        files.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/0000000001")
        os.remove(f"{path}/lists/0000000001/_SUCCESS")
        raise RuntimeError("lost")
    monkeypatch.setattr(listed, "commit", dies)
    changes = spark.createDataFrame([(37, 5, "new")], ROWS)
    with pytest.raises(RuntimeError):
        listed.upsert_listed(spark, table, changes, ["k"], "v")
    assert listed.versions(spark, table) == [0] and listed.read_listed(spark, table).where("v = 5").count() == 0
    monkeypatch.setattr(listed, "commit", real)
    assert listed.upsert_listed(spark, table, changes, ["k"], "v") == 1
    assert listed.read_listed(spark, table).count() == 100 and listed.read_listed(spark, table).where("v = 5").count() == 1


def _loader(spark, seen):
    def load(paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        return spark.read.schema("a INT").option("header", True).csv(paths).select("a", ledger.source_of_row())
    return load


def _csv(root, name, values):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as f:
        f.write("a\n" + "".join(f"{v}\n" for v in values))


def values(spark, table):
    return sorted(r.a for r in listed.read_listed(spark, table).collect())


def test_a_file_is_ingested_once(spark, tmp_dir, monkeypatch):
    root, table, seen = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "t"), []
    load = _loader(spark, seen)

    def run(**kw):
        return ledger.ingest_new(spark, table, ledger.find_files(spark, root, "*.csv"), load, **kw)

    _csv(root, "m 1+%.csv", [1, 2])
    assert run() == 1 and run() == 0 and values(spark, table) == [1, 2]
    _csv(root, "m2.csv", [3])
    assert run() == 1 and run() == 0 and values(spark, table) == [1, 2, 3]
    assert seen == [["m 1+%.csv"], ["m2.csv"]]
    # a run that dies before its list is complete is as if it had not been
    _csv(root, "m3.csv", [4])
    real = listed.commit
    monkeypatch.setattr(listed, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(listed, "commit", real)
    assert values(spark, table) == [1, 2, 3] and run() == 1 and values(spark, table) == [1, 2, 3, 4]
    # changed files are refused, or replaced when asked to
    time.sleep(0.01)
    _csv(root, "m 1+%.csv", [10, 20, 30])
    with pytest.raises(ValueError):
        run()
    assert values(spark, table) == [1, 2, 3, 4]
    assert run(on_change="replace") == 1 and values(spark, table) == [3, 4, 10, 20, 30]
    assert run() == 0 and listed.ledger(spark, table).count() == 3
    # an upsert keeps the ledger
    listed.delete_listed(spark, table, spark.createDataFrame([(4,)], "a INT"), ["a"])
    assert run() == 0 and values(spark, table) == [3, 10, 20, 30]
