import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfare.functions.geo import geodesic_km
from skyfare.operators import enrich, station_index
from skyfare.operators.sizing import BROADCAST_MAX_BYTES_CONF
from tests.test_functions import vincenty_km

STATION_SCHEMA = "station STRING, date DATE, lat DOUBLE, lon DOUBLE, tempAvg DOUBLE"
TRIP_SCHEMA = "trip_id BIGINT, date DATE, PU_lat DOUBLE, PU_lon DOUBLE"


def _d(s):
    import datetime as dt
    return dt.date.fromisoformat(s)


def test_geocode_lookup_default_and_duplicates(spark):
    places = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id INT, name STRING")
    geo = spark.createDataFrame([("A", 1.0, 2.0), ("A", 0.5, 9.0), ("B", 3.0, 4.0)],
                                "place STRING, lat DOUBLE, lng DOUBLE")
    got = {r.id: (r.lat, r.lon) for r in enrich.geocode_lookup(places, "name", geo).collect()}
    assert got == {1: (0.5, 9.0), 2: (3.0, 4.0), 3: (0.0, 0.0)}


def test_zone_joins_drop_unknown_ids(spark):
    trips = spark.createDataFrame([(1, 10, 20), (2, 10, 99), (3, 98, 20)],
                                  "trip_id BIGINT, PULocationID INT, DOLocationID INT")
    points = spark.createDataFrame([(10, 40.7, -74.0), (20, 40.8, -73.9)],
                                   "LocationID INT, lat DOUBLE, lon DOUBLE")
    pu = enrich.join_pickup_zone(trips, points)
    assert sorted(r.trip_id for r in pu.collect()) == [1, 2]
    both = enrich.join_dropoff_zone(pu, points)
    rows = both.collect()
    assert [(r.trip_id, r.PULocationIDAlias, r.LocationID, r.DO_lat) for r in rows] == [(1, 10, 20, 40.8)]


def test_nearest_ties_unmatched_and_clash(spark):
    stations = spark.createDataFrame([
        ("B", _d("2020-01-01"), 40.0, -74.1, 1.0),   # equal distance to A from (40, -74)
        ("A", _d("2020-01-01"), 40.0, -73.9, 2.0),
        ("C", _d("2020-01-01"), 41.0, -74.0, 3.0),
        ("C", _d("2020-01-02"), 41.0, -74.0, 4.0),
    ], STATION_SCHEMA)
    trips = spark.createDataFrame([
        (1, _d("2020-01-01"), 40.0, -74.0),
        (2, _d("2020-01-02"), 40.0, -74.0),
        (3, _d("2020-01-03"), 40.0, -74.0),          # no station that day
    ], TRIP_SCHEMA).withColumn("tempAvg", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(-1.0))
    out = {r.trip_id: r for r in enrich.nearest_station_join(trips, stations).collect()}
    assert out[1].station == "A" and out[1].tempAvg == 2.0      # tie -> smaller name
    assert out[2].station == "C" and out[2].tempAvg == 4.0
    assert out[3].station is None and out[3].tempAvg is None    # station side wins the clash
    assert len(out) == 3


def _brute_force(trips, stations):
    best = {}
    for t in trips:
        cands = [(round(vincenty_km(t[2], t[3], s[2], s[3]), 3), s[0]) for s in stations if s[1] == t[1]]
        best[t[0]] = min(cands)[1] if cands else None
    return best


@pytest.mark.parametrize("force_shuffle", [False, True])
def test_nearest_matches_brute_force(spark, force_shuffle):
    rnd = random.Random(7)
    days = [_d(f"2020-01-0{i}") for i in range(1, 5)]
    stations = [(f"S{j}", day, 40.5 + rnd.random() * 0.6, -74.3 + rnd.random() * 0.6, float(j))
                for j, day in itertools.product(range(6), days[:3])]
    trips = [(i, rnd.choice(days), 40.5 + rnd.random() * 0.6, -74.3 + rnd.random() * 0.6) for i in range(300)]
    if force_shuffle:
        spark.conf.set(BROADCAST_MAX_BYTES_CONF, "1")
    try:
        got = {r.trip_id: r.station for r in enrich.nearest_station_join(
            spark.createDataFrame(trips, TRIP_SCHEMA), spark.createDataFrame(stations, STATION_SCHEMA)).collect()}
    finally:
        spark.conf.unset(BROADCAST_MAX_BYTES_CONF)
    assert got == _brute_force(trips, stations)


def _point_trips(n=300):
    # trips take their pickup point from a small point table; days with no readings,
    # a gap inside the station date range and a day outside it all keep null readings
    rnd = random.Random(11)
    pts = [(round(40.5 + rnd.random() * 0.6, 6), round(-74.3 + rnd.random() * 0.6, 6)) for _ in range(7)]
    pts.append(pts[0])                       # a repeated point must not repeat trips
    days = [_d("2020-01-01"), _d("2020-01-02"), _d("2020-01-04")]
    stations = [(f"S{j}", day, 40.5 + 0.1 * j, -74.3 + 0.1 * j, float(j))
                for j, day in itertools.product(range(5), days) if (j, day.day) != (2, 2)]
    trip_days = days + [_d("2020-01-03"), _d("2019-12-31")]
    return pts, stations, [(i, rnd.choice(trip_days), *rnd.choice(pts)) for i in range(n)]


def test_nearest_with_a_point_table(spark):
    pts, stations, trips = _point_trips()
    st = spark.createDataFrame(stations, STATION_SCHEMA)
    tr = spark.createDataFrame(trips, TRIP_SCHEMA)
    out = enrich.nearest_station_join(tr, st, points=spark.createDataFrame(pts, "PU_lat DOUBLE, PU_lon DOUBLE"))
    got = {r.trip_id: r.station for r in out.collect()}
    assert len(got) == out.count() == 300
    assert got == _brute_force(trips, stations)
    own = enrich.nearest_station_join(tr, st)           # the points read from the trips give the same
    assert sorted(map(tuple, own.select(out.columns).collect()), key=str) == sorted(map(tuple, out.collect()), key=str)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [trip_id") == 1


def test_nearest_at_the_full_date_range_does_not_shuffle_trips(spark):
    # 265 zones x 1,673 days: a narrow row for each still fits the broadcast budget
    points = spark.range(265).selectExpr("40.5 + id * 0.001 AS PU_lat", "-74.2 + id * 0.001 AS PU_lon")
    stations = (spark.range(1673 * 20).selectExpr(
        "concat('S', id % 20) AS station", "date_add(DATE '2017-01-01', CAST(id DIV 20 AS INT)) AS date",
        "40.5 + (id % 20) * 0.0213 + 0.00037 AS lat", "-74.2 + (id % 20) * 0.0191 AS lon", "CAST(id AS DOUBLE) AS tempAvg")
        .where("xxhash64(station, date) % 3 != 0"))
    trips = spark.range(5000, numPartitions=7).selectExpr(
        "id AS trip_id", "date_add(DATE '2017-01-01', CAST(id * 7919 % 1673 AS INT)) AS date",
        "40.5 + (id % 265) * 0.001 AS PU_lat", "-74.2 + (id % 265) * 0.001 AS PU_lon")
    side = enrich.nearest_side(points, stations)
    assert side.small == {"near": True, "readings": True}
    assert side.near.count() <= 265 * 1673
    out = enrich.attach_nearest(trips, side)
    assert out.rdd.getNumPartitions() == 7              # the trips' own partitions: no exchange above their scan
    rows = out.limit(60).collect()
    days = {}
    for r in stations.collect():
        days.setdefault(r.date, []).append((r.station, r.date, r.lat, r.lon))
    want = _brute_force([(r.trip_id, r.date, r.PU_lat, r.PU_lon) for r in rows],
                        [s for d in {r.date for r in rows} for s in days.get(d, [])])
    assert {r.trip_id: r.station for r in rows} == want


def _globe_rows(n, seed, lat=90, lon=180):
    rnd = random.Random(seed)
    rows = [(round(rnd.uniform(-lat, lat), 4), round(rnd.uniform(-lon, lon), 4)) for _ in range(n)]
    return rows + [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (12.0, 179.99), (12.0, -179.99), (89.9, 90.0)]


@pytest.mark.parametrize("level", [None, 4, 5, 7, 9, 12, 16])
def test_index_over_the_globe_equals_all_distances(spark, level):
    # any first level, date line and poles, empty dates and crowds: the same as ranking all stations of the date
    points, places = _globe_rows(40, 1), _globe_rows(150, 2) + _globe_rows(60, 3, 2, 3)
    pairs = spark.createDataFrame([(d, *p) for d in (1, 2, 3) for p in points], "_date INT, _lat DOUBLE, _lon DOUBLE")
    stations = spark.createDataFrame([(1 + i % 2, f"S{i % 170}", *p) for i, p in enumerate(places)],
                                     "_s_date INT, _s STRING, _s_lat DOUBLE, _s_lon DOUBLE")
    place = F.struct(F.col("_s").alias("s"), F.col("_s_lat").alias("a"), F.col("_s_lon").alias("o"))
    km = F.round(geodesic_km("_lat", "_lon", "_s_lat", "_s_lon"), 6)
    want = (pairs.join(stations, F.col("_date") == F.col("_s_date")).groupBy("_date", "_lat", "_lon")
            .agg(F.min(F.struct(km.alias("k"), place.alias("p"))).alias("b")).select("_date", "_lat", "_lon", "b.p", "b.k"))
    got = station_index.nearest_found(pairs, stations, level, place, pairs_small=level == 9)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_reach_is_below_all_distances_outside(spark):
    rnd = random.Random(4)
    rows = []
    for _ in range(4000):
        level = rnd.randint(4, 12)
        side, lat, lon = station_index.side_degrees(level), rnd.uniform(-89, 89), rnd.uniform(-180, 180)
        up, east = rnd.choice([(side, rnd.uniform(0, side)), (rnd.uniform(0, 30), side), (-side, 0.0), (0.0, side), (rnd.uniform(-30, 0), side)])
        rows.append((level, lat, lon, max(-90.0, min(90.0, lat + up)), lon + east, abs(lat + up) <= 90))
    df = spark.createDataFrame(rows, "level INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, inside BOOLEAN").where("inside")
    for level in range(4, 13):
        part = df.where(F.col("level") == level)
        assert part.where(geodesic_km("a", "b", "c", "d") < station_index.reach_km(F.col("a"), level)).isEmpty()


def test_many_stations_on_many_days(spark):
    # 20,000 stations x 400 days = 8 million station days, found through cells, never in one row
    stations = spark.range(20_000 * 400, numPartitions=16).selectExpr(
        "concat('S', id % 20000) AS station", "date_add(DATE '2020-01-01', CAST(id DIV 20000 AS INT)) AS date",
        "25 + pmod(xxhash64(id % 20000), 240007) / 1e4D AS lat", "-120 + pmod(xxhash64(id % 20000, 1), 500009) / 1e4D AS lon",
        "CAST(id AS DOUBLE) AS tempAvg")
    trips = spark.range(2000).selectExpr(
        "id AS trip_id", "date_add(DATE '2020-01-01', CAST(id % 400 AS INT)) AS date",
        "26 + (id % 25) * 0.7D AS PU_lat", "-118 + (id % 25) * 1.7D AS PU_lon")
    out = enrich.nearest_station_join(trips, stations)
    rows = out.collect()
    assert len(rows) == 2000 and all(r.station is not None for r in rows)
    places = [(r.station, r.lat, r.lon) for r in stations.where("date = DATE '2020-01-01'").select("station", "lat", "lon").collect()]
    lat, lon = np.array([p[1] for p in places]), np.array([p[2] for p in places])
    for r in rows[:40]:  # all days have the same stations
        near = np.argsort((lat - r.PU_lat) ** 2 + ((lon - r.PU_lon) * np.cos(np.radians(r.PU_lat))) ** 2)[:30]
        assert r.station == min((round(vincenty_km(r.PU_lat, r.PU_lon, lat[i], lon[i]), 3), places[i][0]) for i in near)[1]
        assert int(r.tempAvg) % 20_000 == int(r.station[1:])
