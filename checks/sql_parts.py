"""Reusable DuckDB SQL fragments mirroring the stand-in tables of skyfare.sources.proxies.

Every double literal that is not a short decimal is written as a quoted string
cast to DOUBLE, so DuckDB parses it with correct rounding.
"""

from __future__ import annotations

from skyfare.functions.geo import WGS84_A_KM, WGS84_F
from skyfare.sources.proxies import STATION_NAMES


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def geodesic_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    one_minus_f = dbl(1.0 - WGS84_F)
    b1 = f"atan({one_minus_f} * tan(radians({lat1})))"
    b2 = f"atan({one_minus_f} * tan(radians({lat2})))"
    dl = f"(radians({lon2}) - radians({lon1}))"
    h = (f"(pow(sin(({b2} - {b1}) / 2), 2) + cos({b1}) * cos({b2}) * pow(sin({dl} / 2), 2))")
    s = f"(2.0 * asin(sqrt(least(greatest({h}, 0.0), 1.0))))"
    p = f"(({b1} + {b2}) / 2)"
    q = f"(({b2} - {b1}) / 2)"
    x = f"(({s} - sin({s})) * pow(sin({p}) * cos({q}) / nullif(cos({s} / 2), 0.0), 2))"
    y = f"(({s} + sin({s})) * pow(cos({p}) * sin({q}) / nullif(sin({s} / 2), 0.0), 2))"
    d = f"({dbl(WGS84_A_KM)} * ({s} - {dbl(WGS84_F / 2)} * ({x} + {y})))"
    return f"(CASE WHEN {s} = 0 THEN 0.0 ELSE {d} END)"


TRIP_BASE = """
trip_base AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_nationkey, c.c_acctbal,
         date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 40 AS day_off,
         (o.o_orderkey * 7919) % 86400 AS sec_off,
         (o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P') AS broken
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

TRIPS = TRIP_BASE + """,
trips AS (
  SELECT o_orderkey AS trip_id,
         CASE WHEN broken THEN 'n/a' ELSE strftime(TIMESTAMP '2024-01-01 00:00:00'
              + to_seconds(CAST(day_off * 86400 + sec_off AS BIGINT)), '%Y-%m-%d %H:%M:%S') END
           AS lpep_pickup_datetime,
         CASE WHEN broken THEN DATE '1970-01-01'
              ELSE CAST(DATE '2024-01-01' + CAST(day_off AS INTEGER) AS DATE) END AS date,
         CASE WHEN broken THEN 0.0 ELSE CAST(o_custkey % 3000 + 60 AS DOUBLE) END AS trip_duration,
         CAST(c_nationkey AS INTEGER) AS PULocationID,
         CAST(o_orderkey % 27 AS INTEGER) AS DOLocationID,
         CAST(o_orderkey % 6 + 1 AS DOUBLE) AS passenger_count,
         o_totalprice / CAST(10000.0 AS DOUBLE) AS trip_distance,
         o_totalprice / CAST(100.0 AS DOUBLE) AS fare_amount,
         (o_totalprice + c_acctbal) / CAST(100.0 AS DOUBLE) AS total_amount
  FROM trip_base
)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Boro Zone' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
zone_geo AS (
  SELECT n_name AS place,
         CAST(40.5 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS lat,
         CAST(-74.2 AS DOUBLE) + CAST(n_nationkey // 5 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS lng
  FROM nation WHERE NOT suffix(n_name, '3')
),
zone_pts AS (
  SELECT z.LocationID, coalesce(g.lat, 0.0) AS lat, coalesce(g.lng, 0.0) AS lon
  FROM zones z LEFT JOIN zone_geo g ON z.Zone = g.place
)"""

LOCATED = """
located AS (
  SELECT t.*, pu.LocationID AS PULocationIDAlias, pu.lat AS PU_lat, pu.lon AS PU_lon,
         d.LocationID AS LocationID, d.lat AS DO_lat, d.lon AS DO_lon
  FROM trips t JOIN zone_pts pu ON t.PULocationID = pu.LocationID
               JOIN zone_pts d ON t.DOLocationID = d.LocationID
)"""


def _station_case() -> str:
    whens = " ".join(f"WHEN {j} THEN '{n}'" for j, n in enumerate(STATION_NAMES))
    return f"CASE j {whens} END"


def _station_geo_values() -> str:
    rows = []
    for j, name in enumerate(STATION_NAMES):
        lat = 40.55 + j * 0.13
        lng = -74.15 + ((j * 3) % 4) * 0.11
        rows.append(f"('{name}', {dbl(lat)}, {dbl(lng)})")
    return ", ".join(rows)


STATIONS = f"""
ev AS (
  SELECT CAST(ts AS DATE) AS day, CAST(user_id % 4 AS INTEGER) AS j, event_type,
         CAST(round(value * 100) AS BIGINT) AS c
  FROM events
),
sd AS (
  SELECT day, j, max(c) AS cmax, min(c) AS cmin, sum(c) AS csum, count(*) AS n,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_err
  FROM ev GROUP BY day, j
),
station_rows AS (
  SELECT {_station_case()} AS station, day AS date,
         CAST(cmax AS DOUBLE) / CAST(100.0 AS DOUBLE) AS tempMax,
         CAST(cmin AS DOUBLE) / CAST(100.0 AS DOUBLE) AS tempMin,
         CAST(csum AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100.0 AS DOUBLE) AS tempAvg,
         CAST(csum AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100.0 AS DOUBLE) - CAST(50.0 AS DOUBLE) AS tempDeparture,
         greatest(CAST(65.0 AS DOUBLE) - CAST(csum AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100.0 AS DOUBLE), CAST(0.0 AS DOUBLE)) AS hdd,
         greatest(CAST(csum AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100.0 AS DOUBLE) - CAST(65.0 AS DOUBLE), CAST(0.0 AS DOUBLE)) AS cdd,
         CASE WHEN n_err = 0 THEN NULL ELSE CAST(n_err AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS precipitation,
         CAST(NULL AS DOUBLE) AS newSnow,
         CAST(0.0 AS DOUBLE) AS snowDepth
  FROM sd
),
station_geo(place, lat, lng) AS (VALUES {_station_geo_values()}),
stations AS (
  SELECT s.*, coalesce(g.lat, 0.0) AS lat, coalesce(g.lng, 0.0) AS lon
  FROM station_rows s LEFT JOIN station_geo g ON s.station = g.place
)"""

NEAREST = f"""
cand AS (
  SELECT l.trip_id, s.station, s.lat, s.lon, s.tempMax, s.tempMin, s.tempAvg, s.tempDeparture,
         s.hdd, s.cdd, s.precipitation, s.newSnow, s.snowDepth,
         round({geodesic_sql('l.PU_lat', 'l.PU_lon', 's.lat', 's.lon')}, 6) AS distance_km
  FROM located l JOIN stations s ON l.date = s.date
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY distance_km, station) AS rn FROM cand
),
merged AS (
  SELECT l.*, r.station, r.lat, r.lon, r.distance_km, r.tempMax, r.tempMin, r.tempAvg,
         r.tempDeparture, r.hdd, r.cdd, r.precipitation, r.newSnow, r.snowDepth
  FROM located l LEFT JOIN ranked r ON l.trip_id = r.trip_id AND r.rn = 1
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts)
