import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfare.functions import geodesic_km, month_key, month_str, pickup_date, trip_duration_seconds, try_double


def vincenty_km(lat1, lon1, lat2, lon2):
    """Reference: Vincenty's inverse formula on WGS-84 (iterative)."""
    a, f = 6378.137, 1 / 298.257223563
    b = (1 - f) * a
    L = math.radians(lon2 - lon1)
    U1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    U2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sin_lam, cos_lam = math.sin(lam), math.cos(lam)
        sin_sigma = math.hypot(cosU2 * sin_lam, cosU1 * sinU2 - sinU1 * cosU2 * cos_lam)
        if sin_sigma == 0:
            return 0.0
        cos_sigma = sinU1 * sinU2 + cosU1 * cosU2 * cos_lam
        sigma = math.atan2(sin_sigma, cos_sigma)
        sin_alpha = cosU1 * cosU2 * sin_lam / sin_sigma
        cos2_alpha = 1 - sin_alpha ** 2
        cos2sm = cos_sigma - 2 * sinU1 * sinU2 / cos2_alpha if cos2_alpha else 0.0
        C = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
        prev = lam
        lam = L + (1 - C) * f * sin_alpha * (sigma + C * sin_sigma * (cos2sm + C * cos_sigma * (-1 + 2 * cos2sm ** 2)))
        if abs(lam - prev) < 1e-13:
            break
    u2 = cos2_alpha * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * sin_sigma * (cos2sm + B / 4 * (cos_sigma * (-1 + 2 * cos2sm ** 2)
                                            - B / 6 * cos2sm * (-3 + 4 * sin_sigma ** 2) * (-3 + 4 * cos2sm ** 2)))
    return b * A * (sigma - ds)


def _dist(spark, rows):
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    return [r[0] for r in df.select(geodesic_km("a", "b", "c", "d")).collect()]


def test_geodesic_zero_and_symmetric(spark):
    out = _dist(spark, [(40.7, -74.0, 40.7, -74.0), (40.6, -73.9, 40.8, -74.1), (40.8, -74.1, 40.6, -73.9)])
    assert out[0] == 0.0
    assert abs(out[1] - out[2]) < 1e-9


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(40.0, 41.5), st.floats(-74.8, -73.0),
                          st.floats(40.0, 41.5), st.floats(-74.8, -73.0)), min_size=1, max_size=20))
def test_geodesic_matches_vincenty(spark, pts):
    got = _dist(spark, pts)
    for (a, b, c, d), g in zip(pts, got):
        ref = vincenty_km(a, b, c, d)
        assert abs(g - ref) <= 1e-5 * max(ref, 1e-3) + 1e-9


def test_pickup_date_rules(spark):
    rows = [("2020-01-05 10:11:12",), ("2020-01-05",), ("2020-01-05T23:59:59",), ("n/a",), ("",), (None,)]
    df = spark.createDataFrame(rows, "p STRING")
    got = [r[0] for r in df.select(pickup_date("p")).collect()]
    epoch = dt.date(1970, 1, 1)
    assert got == [dt.date(2020, 1, 5), dt.date(2020, 1, 5), dt.date(2020, 1, 5), epoch, epoch, epoch]


def test_trip_duration(spark):
    rows = [("2020-01-01 10:00:00", "2020-01-01 10:15:30"), ("2020-01-01 10:00:00", "2020-01-01 09:59:00"),
            ("bad", "2020-01-01 10:00:00"), (None, None)]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    got = [r[0] for r in df.select(trip_duration_seconds("a", "b")).collect()]
    assert got == [930.0, -60.0, 0.0, 0.0]


def test_try_double_and_months(spark):
    df = spark.createDataFrame([("1.5", 3), ("M", 11), ("T", 1), ("", 12)], "s STRING, m INT")
    got = df.select(try_double("s"), month_str("m"),
                    month_key(F.make_date(F.lit(2021), "m", F.lit(1)))).collect()
    assert [r[0] for r in got] == [1.5, None, None, None]
    assert [r[1] for r in got] == ["03", "11", "01", "12"]
    assert [r[2] for r in got] == ["2021_03", "2021_11", "2021_01", "2021_12"]


def test_trip_duration_ignores_session_time_zone(spark):
    df = spark.createDataFrame([("2021-03-14 01:30:00", "2021-03-14 03:30:00")], "a STRING, b STRING")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(trip_duration_seconds("a", "b"), pickup_date("a")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == 7200.0 and got[1] == dt.date(2021, 3, 14)


def test_written_tables_are_discarded_on_request(spark):
    from skyfare import session
    kept, session._WRITTEN[:] = list(session._WRITTEN), []
    df = session.write_once(spark.range(5).toDF("x"), "discard-me")
    path = session._WRITTEN[0]
    assert df.count() == 5 and session.discard_written(spark) == 1
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    session._WRITTEN[:] = kept
