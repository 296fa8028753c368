"""Bucketed tables: changes are merged without a shuffle of the base."""

import os
import re

import pytest
from pyspark.sql import functions as F

from skyfare.sources import lake

BUCKETS = 8
BASE = "a BIGINT, b STRING, v BIGINT, s STRING"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def base(spark, tmp_dir):
    """Keys of two columns, some of several rows, some with nulls; one key holds a third of all rows."""
    data = [(i % 200, "xyz"[i % 3], i, "old") for i in range(600)] + [(7, "hot", i, "old") for i in range(300)]
    data += [(None, "x", 1, "old"), (None, "x", 2, "old"), (5, None, 1, "old"), (None, None, 3, "old")]
    df = spark.createDataFrame(data, BASE)
    lake.write_bucketed(df, "bucketed_base", ["a", "b"], BUCKETS, os.path.join(tmp_dir, "base"))
    yield df
    for t in ("bucketed_base", "bucketed_out", "bucketed_again"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_upsert_and_delete_as_on_plain_tables(spark, base, tmp_dir):
    changes = spark.createDataFrame([(i, "x", 1000 - i, "new") for i in range(0, 300, 2)]
                                    + [(7, "hot", 150, "new"), (None, "x", 2, "new"), (None, None, 0, "new"),
                                       (9, None, 1, "new")], BASE)
    out = lake.upsert_bucketed(spark, "bucketed_base", changes, ["a", "b"], "v", "bucketed_out", BUCKETS,
                               os.path.join(tmp_dir, "out"))
    assert rows(out) == rows(lake.upsert_rows(base, changes, ["a", "b"], "v"))
    keys = changes.select("a", "b", F.lit(1).alias("extra")).where("s = 'new' AND (a IS NULL OR a < 50)")
    again = lake.delete_bucketed(spark, "bucketed_out", keys, ["a", "b"], "bucketed_again", BUCKETS,
                                 os.path.join(tmp_dir, "again"))
    assert rows(again) == rows(lake.delete_rows(out, keys, ["a", "b"])) and again.count() < out.count()
    none = changes.limit(0)
    assert rows(lake.upsert_bucketed(spark, "bucketed_base", none, ["a", "b"], "v", "bucketed_out", BUCKETS,
                                     os.path.join(tmp_dir, "none"))) == rows(base)


def test_the_base_is_not_shuffled(spark, base, tmp_dir, monkeypatch):
    plans = []
    real = lake.write_bucketed
    monkeypatch.setattr(lake, "write_bucketed", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a, **k)))
    changes = spark.createDataFrame([(i, "x", 1000, "new") for i in range(300)], BASE)
    lake.upsert_bucketed(spark, "bucketed_base", changes, ["a", "b"], "v", "bucketed_out", BUCKETS, os.path.join(tmp_dir, "out"))
    lake.delete_bucketed(spark, "bucketed_out", changes, ["a", "b"], "bucketed_again", BUCKETS, os.path.join(tmp_dir, "again"))
    assert len(plans) == 2
    for plan in plans:
        lines = plan.split("\n")
        depth = [len(re.match(r"[\s:|+-]*", line).group()) for line in lines]
        checked = 0
        for i, line in enumerate(lines):
            if "LeftAnti" in line and "BroadcastHashJoin" not in line:
                left = next(j for j in range(i + 1, len(lines)) if "FileScan" in lines[j])
                assert "Bucketed: true" in lines[left]
                assert not any("Exchange" in x for x in lines[i:left]), plan  # nothing between the scan and its join
                assert depth[left] > depth[i]
                checked += 1
        assert checked >= 1, plan
