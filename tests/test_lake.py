import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfare.sources import lake
from skyfare.sources.trips import TRIP_KINDS, month_list, scan_month_range, scan_trips, type_trips

EV = "event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"


def _ts(h):
    return dt.datetime(2024, 1, 1, h)


def test_database_append_and_read(spark, tmp_dir):
    prev = spark.catalog.currentDatabase()
    lake.use_database(spark, "skyfare_test_db", os.path.join(tmp_dir, "db"))
    assert spark.catalog.currentDatabase() == "skyfare_test_db"
    spark.catalog.setCurrentDatabase(prev)
    df = spark.createDataFrame([(1, _ts(1), 1.0)], EV)
    lake.append_table(df, "skyfare_test_db.t1", as_table=True)
    lake.append_table(df, "skyfare_test_db.t1", as_table=True)
    assert lake.read_table(spark, "skyfare_test_db.t1").count() == 2      # bulk insert, no dedup
    out = lake.raw_sql(spark, "SELECT count(*) AS n FROM skyfare_test_db.t1 WHERE value >= :v", {"v": 0.5})
    assert out.first().n == 2


def test_upsert_latest_wins_change_wins_ties_idempotent(spark, tmp_dir):
    base = spark.createDataFrame([(1, _ts(1), 1.0), (2, _ts(5), 2.0), (3, _ts(1), 3.0)], EV)
    changes = spark.createDataFrame([(1, _ts(2), 10.0), (2, _ts(4), 20.0), (3, _ts(1), 30.0), (4, _ts(1), 4.0)], EV)
    once = lake.upsert_rows(base, changes, ["event_id"], "ts")
    got = {r.event_id: r.value for r in once.collect()}
    assert got == {1: 10.0, 2: 2.0, 3: 30.0, 4: 4.0}
    twice = lake.upsert_rows(once, changes, ["event_id"], "ts")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    p0 = os.path.join(tmp_dir, "base")
    base.write.parquet(p0)
    out = lake.upsert_table(spark, p0, changes, ["event_id"], "ts", os.path.join(tmp_dir, "v1"))
    assert out.count() == 4 and spark.read.parquet(p0).count() == 3      # source untouched


def test_upsert_broadcast_path_equals_grouped_path(spark):
    # unique base keys plus a null key; changes repeat keys and touch the null key
    base = spark.createDataFrame([(i, _ts(i % 7), float(i)) for i in range(1, 200)] + [(None, _ts(1), -1.0)], EV)
    changes = spark.createDataFrame([(i % 50, _ts(i % 9), 1000.0 + i) for i in range(0, 120)] + [(None, _ts(3), -2.0)], EV)
    fast = lake.upsert_rows(base, changes, ["event_id"], "ts", changes_small=True)
    full = lake.upsert_rows(base, changes, ["event_id"], "ts", changes_small=False)
    assert sorted(map(tuple, fast.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert fast.where("event_id IS NULL").first().value == -2.0
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_delete_by_key(spark, tmp_dir):
    base = spark.createDataFrame([(1, _ts(1), 1.0), (2, _ts(1), 2.0), (3, _ts(1), 3.0)], EV)
    keys = spark.createDataFrame([(2,), (2,), (9,)], "event_id BIGINT")
    assert sorted(r.event_id for r in lake.delete_rows(base, keys, ["event_id"]).collect()) == [1, 3]


def test_rebalanced_write_gives_few_files_per_partition(spark, tmp_dir):
    # 16 input partitions, every one holding rows of both months
    df = spark.range(4000, numPartitions=16).selectExpr("id AS k", "2020 AS year", "CAST(1 + id % 2 AS INT) AS month")
    out = os.path.join(tmp_dir, "rebalanced")
    lake.append_partitioned(df, out, ["year", "month"])
    for m in ("month=1", "month=2"):
        files = [f for f in os.listdir(os.path.join(out, "year=2020", m)) if f.endswith(".parquet")]
        assert len(files) == 1
    assert spark.read.parquet(out).count() == 4000


def test_partitioned_write_and_month_scans(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2), (3, 2020, 3)], "k INT, year INT, month INT")
    hive = os.path.join(tmp_dir, "hive")
    lake.append_partitioned(df, hive, ["year", "month"])
    assert sorted(os.listdir(os.path.join(hive, "year=2020"))) == ["month=1", "month=2", "month=3"]
    got = scan_month_range(spark, hive, "2020-02", "2020-03", layout="hive", fmt="parquet")
    assert sorted(r.k for r in got.collect()) == [2, 3]
    # plain layout root/YYYY/MM/*.csv, as the trip downloader saves it
    plain = os.path.join(tmp_dir, "plain")
    for y, m, pu in [(2019, 12, "1"), (2020, 1, "2"), (2020, 2, "3")]:
        os.makedirs(os.path.join(plain, f"{y}", f"{m:02d}"))
        with open(os.path.join(plain, f"{y}", f"{m:02d}", "green.csv"), "w") as fh:
            fh.write("lpep_pickup_datetime,PULocationID,total_amount\n")
            fh.write(f"{y}-{m:02d}-03 10:00:00,{pu},12.5\n")
    got = scan_month_range(spark, plain, "2020-01", "2020-07").collect()
    assert sorted((r.year, r.month, r.PULocationID) for r in got) == [(2020, 1, "2"), (2020, 2, "3")]
    empty = scan_month_range(spark, plain, "2021-01", "2021-02", empty_schema="a STRING")
    assert empty.count() == 0
    assert month_list("2020-11", "2021-02") == ["2020/11", "2020/12", "2021/01", "2021/02"]


def test_month_scan_reads_each_trip_kind_with_its_own_header(spark, tmp_dir):
    # green and yellow files side by side, with different columns in a different order
    root = os.path.join(tmp_dir, "kinds")
    os.makedirs(os.path.join(root, "2020", "01"))
    with open(os.path.join(root, "2020", "01", "green_tripdata_2020-01.csv"), "w") as fh:
        fh.write("lpep_pickup_datetime,PULocationID,total_amount\n2020-01-03 10:00:00,7,12.5\n")
    with open(os.path.join(root, "2020", "01", "yellow_tripdata_2020-01.csv"), "w") as fh:
        fh.write("VendorID,tpep_pickup_datetime,total_amount,PULocationID\n2,2020-01-04 11:00:00,30.0,9\n")
    got = type_trips(scan_month_range(spark, root, "2020-01", "2020-01", kinds=TRIP_KINDS))
    rows = {r.trip_kind: r for r in got.collect()}
    assert (rows["green"].PULocationID, rows["green"].total_amount, rows["green"].date) == (7, 12.5, dt.date(2020, 1, 3))
    assert (rows["yellow"].PULocationID, rows["yellow"].total_amount, rows["yellow"].date) == (9, 30.0, dt.date(1970, 1, 1))
    assert rows["yellow"].VendorID == "2" and rows["green"].VendorID is None
    assert (rows["yellow"].year, rows["yellow"].month) == (2020, 1)


def test_scan_trips_csv_types_and_yellow_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "trips.csv")
    with open(path, "w") as fh:
        fh.write("lpep_pickup_datetime,lpep_dropoff_datetime,PULocationID,DOLocationID,passenger_count,total_amount\n")
        fh.write("2020-01-01 10:00:00,2020-01-01 10:10:00,7,8,1,12.5\n")
        fh.write("garbage,,x,8,,M\n")
    rows = scan_trips(spark, path).orderBy(F.col("PULocationID").asc_nulls_last()).collect()
    assert rows[0].PULocationID == 7 and rows[0].total_amount == 12.5 and rows[0].date == dt.date(2020, 1, 1)
    assert rows[1].PULocationID is None and rows[1].total_amount is None and rows[1].date == dt.date(1970, 1, 1)
    # yellow files have no lpep_pickup_datetime: every date is the default
    ypath = os.path.join(tmp_dir, "yellow.csv")
    with open(ypath, "w") as fh:
        fh.write("tpep_pickup_datetime,PULocationID\n2020-01-01 10:00:00,7\n")
    assert scan_trips(spark, ypath).first().date == dt.date(1970, 1, 1)


def test_upsert_keeps_repeated_rows_of_untouched_keys(spark):
    # bulk appends leave several rows of a key; only keys that the changes touch are reduced
    base = spark.createDataFrame([(1, _ts(1), 10.0), (1, _ts(2), 11.0), (2, _ts(1), 2.0), (2, _ts(1), 3.0)], EV)
    changes = spark.createDataFrame([(2, _ts(2), 20.0)], EV)
    for small in (True, False):
        got = sorted(map(tuple, lake.upsert_rows(base, changes, ["event_id"], "ts", changes_small=small).collect()))
        assert got == [(1, _ts(1), 10.0), (1, _ts(2), 11.0), (2, _ts(2), 20.0)]


def test_upsert_with_a_map_column(spark):
    schema = "k INT, ts INT, props MAP<STRING, INT>"
    base = spark.createDataFrame([(1, 1, {"a": 1}), (2, 1, None)], schema)
    changes = spark.createDataFrame([(1, 1, {"b": 2}), (3, 1, {"c": 3})], schema)
    got = {r.k: r.props for r in lake.upsert_rows(base, changes, ["k"], "ts").collect()}
    assert got == {1: {"b": 2}, 2: None, 3: {"c": 3}}


def test_delete_compares_null_keys_as_upsert_does(spark):
    base = spark.createDataFrame([(None, _ts(1), 1.0), (2, _ts(1), 2.0)], EV)
    keys = spark.createDataFrame([(None,)], "event_id BIGINT")
    assert [r.event_id for r in lake.delete_rows(base, keys, ["event_id"]).collect()] == [2]


def test_mixed_headers_fail_and_only_missing_paths_are_empty(spark, tmp_dir):
    root = os.path.join(tmp_dir, "mixed", "2020", "01")
    os.makedirs(root)
    for name, text in (("green.csv", "a,b,c\n1,2,3\n"), ("yellow.csv", "a,x,b,c\n1,9,2,3\n")):
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        scan_month_range(spark, os.path.join(tmp_dir, "mixed"), "2020-01", "2020-01").collect()
    with open(os.path.join(tmp_dir, "mixed", "2020", "01", "bad.parquet"), "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        scan_month_range(spark, os.path.join(tmp_dir, "mixed"), "2020-01", "2020-01", fmt="nosuchformat")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.integers(0, 5)), max_size=15),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.integers(0, 5)), max_size=20))
def test_upsert_properties(spark, base_rows, change_rows):
    # base keys repeat (also the null key); changes repeat keys and tie on time
    rows_of_base = [(k, _ts(t), float(i)) for i, (k, t) in enumerate(base_rows)]
    rows_of_changes = [(k, _ts(t), 100.0 + i) for i, (k, t) in enumerate(change_rows)]
    base, changes = spark.createDataFrame(rows_of_base, EV), spark.createDataFrame(rows_of_changes, EV)
    fast = lake.upsert_rows(base, changes, ["event_id"], "ts", changes_small=True)
    full = lake.upsert_rows(base, changes, ["event_id"], "ts", changes_small=False)
    rows = sorted(map(tuple, fast.collect()), key=str)
    assert rows == sorted(map(tuple, full.collect()), key=str)
    touched = {k for k, _ in change_rows}
    assert [r for r in rows if r[0] not in touched] == sorted([r for r in rows_of_base if r[0] not in touched], key=str)
    for k in touched:
        own = [r for r in rows if r[0] == k]
        latest = max(r[1] for r in rows_of_base + rows_of_changes if r[0] == k)
        changed = [r for r in rows_of_changes if r[0] == k and r[1] == latest]
        assert len(own) == 1 and own[0][1] == latest and (not changed or own[0] in changed)
    again = lake.upsert_rows(fast, changes, ["event_id"], "ts", changes_small=True)
    assert sorted(map(tuple, again.collect()), key=str) == rows
