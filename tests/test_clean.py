from skyfare.operators import clean


def test_fill_zero_numeric_only_and_drop(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.5, "x")], "a INT, b DOUBLE, s STRING")
    filled = clean.fill_zero(df)
    assert [tuple(r) for r in filled.orderBy("a").collect()] == [(1, 0.0, None), (2, 1.5, "x")]
    assert [r.a for r in clean.drop_incomplete(filled).collect()] == [2]


def test_rename_cast_and_fare_features(spark):
    df = spark.createDataFrame([("1.5", "2", "M", "10")],
                               "trip_distance STRING, passenger_count STRING, tempAvg STRING, total_amount STRING")
    df = clean.cast_features(clean.rename_columns(df, {"tempAvg": "weather", "absent": "x"}))
    assert df.columns == ["trip_distance", "passenger_count", "weather", "total_amount"]
    r = clean.fare_features(df).first()
    assert (r.trip_distance, r.passenger_count, r.weather, r.fare) == (1.5, 2, None, 10.0)


def test_surrogate_id_deterministic_and_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (1, None)], "k BIGINT, s STRING")
    a = [r.id for r in clean.surrogate_id(df, ["k", "s"]).orderBy("k", "s").collect()]
    b = [r.id for r in clean.surrogate_id(df, ["k", "s"]).orderBy("k", "s").collect()]
    assert a == b and len(set(a)) == 3 and all(len(x) == 64 for x in a)


def test_limit_rows_and_month_grid(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in clean.limit_rows(df, 3, ["k"]).collect()] == [0, 1, 2]
    st = spark.createDataFrame([("A",), ("A",), ("B",)], "station STRING")
    grid = clean.month_station_grid(st, "2020-11", "2021-02").collect()
    assert len(grid) == 8
    assert sorted({r.month_key for r in grid}) == ["2020_11", "2020_12", "2021_01", "2021_02"]


def test_overlay_right_wins(spark):
    left = spark.createDataFrame([(1, "l", 1.0)], "k INT, name STRING, v DOUBLE")
    right = spark.createDataFrame([(1, "r")], "k INT, name STRING")
    r = clean.overlay_columns(left, right, ["k"]).first()
    assert (r.k, r.name, r.v) == (1, "r", 1.0)


def test_fill_zero_and_drop_equals_fill_then_drop(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "a"), (None, 2.0, "b"), (3, None, None), (4, 4.0, "d"), (None, None, "e")],
        "n INT, x DOUBLE, s STRING")
    got = sorted(map(tuple, clean.fill_zero_and_drop(df).collect()))
    want = sorted(map(tuple, clean.drop_incomplete(clean.fill_zero(df)).collect()))
    assert got == want == [(0, 0.0, "e"), (0, 2.0, "b"), (1, 0.0, "a"), (4, 4.0, "d")]


def test_surrogate_ids_of_different_keys_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("x", None), ("x", ""), ("1:a", "b"), ("-", None)]
    out = clean.surrogate_id(spark.createDataFrame(rows, "p STRING, q STRING"), ["p", "q"])
    assert out.select("id").distinct().count() == len(rows)


def test_ingest_drop_takes_a_column_subset(spark):
    df = spark.createDataFrame([(1, "g", None), (2, None, "y"), (None, "g", None)], "n INT, green STRING, yellow STRING")
    assert clean.fill_zero_and_drop(df).count() == 0
    assert clean.fill_zero_and_drop(df, ["n"]).count() == 3
    assert clean.fill_zero_and_drop(df, ["green"]).count() == 2
