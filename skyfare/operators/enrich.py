"""Joins that put places on the map and weather on the trips.

geocode_lookup        place name -> (lat, lon) by a left join; no match -> (0.0, 0.0)
join_pickup_zone      trips x zones on PULocationID (inner)
join_dropoff_zone     trips x zones on DOLocationID (inner)
nearest_station_join  per trip, the station of the same date nearest to the pickup point
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.operators.sizing import broadcast_budget, broadcast_if_small, checked_count, concurrently, row_bytes
from skyfare.operators.station_index import first_level, fits, nearest_by_order, nearest_found
from skyfare.session import write_once


def _dedup_geocodes(geocodes: DataFrame, place_col: str = "place",
                    lat_col: str = "lat", lng_col: str = "lng") -> DataFrame:
    # one row per place; a repeated place keeps its smallest (lat, lng)
    best = F.min(F.struct(F.col(lat_col).alias("lat"), F.col(lng_col).alias("lng")))
    return (geocodes.groupBy(F.col(place_col).alias("_place")).agg(best.alias("_g"))
                    .select("_place", F.col("_g.lat").alias("_glat"), F.col("_g.lng").alias("_glng")))


def geocode_lookup(df: DataFrame, place_col: str, geocodes: DataFrame,
                   lat_name: str = "lat", lon_name: str = "lon",
                   geocodes_small: bool | None = None) -> DataFrame:
    """Add (lat, lon) of ``place_col`` from a geocode table (place, lat, lng).

    Unknown places get (0.0, 0.0), as the geocoding service failure did.  The
    geocode table is broadcast only after a size check; the check counts the
    raw table (a plain scan), which bounds its de-duplicated form.
    """
    g = _dedup_geocodes(geocodes)
    if geocodes_small is None:
        geocodes_small = checked_count(geocodes) is not None
    g = _maybe_broadcast(g, geocodes_small)
    joined = df.join(g, F.col(place_col) == F.col("_place"), "left")
    keep = [F.col(c) for c in df.columns if c not in (lat_name, lon_name)]
    return joined.select(*keep, F.coalesce(F.col("_glat"), F.lit(0.0)).alias(lat_name),
                         F.coalesce(F.col("_glng"), F.lit(0.0)).alias(lon_name))


def zone_points(zones: DataFrame, geocodes: DataFrame, geocodes_small: bool | None = None) -> DataFrame:
    """Zones -> (LocationID, lat, lon) via the geocode table on the zone name."""
    return geocode_lookup(zones.select("LocationID", "Zone"), "Zone", geocodes,
                          geocodes_small=geocodes_small).select("LocationID", "lat", "lon")


def _maybe_broadcast(df: DataFrame, small: bool | None) -> DataFrame:
    if small is None:
        return broadcast_if_small(df)[0]
    return F.broadcast(df) if small else df


def join_pickup_zone(trips: DataFrame, points: DataFrame, small: bool | None = None) -> DataFrame:
    """Inner join on PULocationID; adds PU_lat, PU_lon, PULocationIDAlias.

    ``small``: the caller's verdict of a size check on ``points`` (None: check here).
    """
    pu = points.select(F.col("LocationID").alias("PULocationIDAlias"),
                       F.col("lat").alias("PU_lat"), F.col("lon").alias("PU_lon"))
    pu = _maybe_broadcast(pu, small)
    return trips.join(pu, trips["PULocationID"] == pu["PULocationIDAlias"], "inner")


def join_dropoff_zone(trips: DataFrame, points: DataFrame, small: bool | None = None) -> DataFrame:
    """Inner join on DOLocationID; adds DO_lat, DO_lon and keeps LocationID."""
    do = points.select("LocationID", F.col("lat").alias("DO_lat"), F.col("lon").alias("DO_lon"))
    do = _maybe_broadcast(do, small)
    return trips.join(do, trips["DOLocationID"] == do["LocationID"], "inner")


@dataclass
class NearestSide:
    """What the nearest-station join reads besides the trips; ``small`` has a verdict for each table.

    near      (date, lat, lon) of a pickup point -> the nearest station that reports on the date, its distance
    readings  (date, station, place) -> the station's readings
    """
    near: DataFrame
    readings: DataFrame
    small: dict[str, bool]


def nearest_side(points: DataFrame, stations: DataFrame, date_col: str = "date", lat_col: str = "PU_lat",
                 lon_col: str = "PU_lon", station_col: str = "station", st_lat: str = "lat", st_lon: str = "lon",
                 n_points: int | None = None) -> NearestSide:
    """The two tables for ``points`` and ``stations`` (one row for each station and day).

    ``points`` are places (lat, lon), to be matched on every date of the stations,
    or pairs (date, lat, lon).  The nearest station of each (date, point) is found
    by a grid index over the station days (``station_index``).  Sizes follow from
    one pass over the stations and a count of the points (``n_points``, if known).
    Distances are rounded to 1e-6 km; ties go to the smaller station name.  Of
    several rows of one station and day the smallest stays.
    """
    st = stations.where(F.col(st_lat).isNotNull() & F.col(st_lon).isNotNull() & F.col(date_col).isNotNull())
    paired = date_col in points.columns
    points = points.select(*([date_col] if paired else []), lat_col, lon_col)
    points = points.where(F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull())
    days = st.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(st)).alias("bytes"), F.max(F.octet_length(station_col)).alias("name"),
        *[f(F.col(c).cast("double")).alias(f"{k}_{x}") for k, f in (("min", F.min), ("max", F.max))
          for c, x in ((st_lat, "lat"), (st_lon, "lon"))])
    sums = days.agg(F.max("n").alias("busiest"), F.count(F.lit(1)).alias("days"), F.sum("bytes").alias("bytes"),
                    F.max("name").alias("name"), (F.max("max_lat") - F.min("min_lat")).alias("lat_span"),
                    (F.max("max_lon") - F.min("min_lon")).alias("lon_span"))
    known, n_points, n_places = concurrently([
        sums.first, lambda: points.count() if n_points is None else n_points,
        st.select(station_col, st_lat, st_lon).distinct().count])
    pairs = n_points * (1 if paired else known["days"])
    small = {"near": fits(pairs, known["name"] or 0, points), "readings": (known["bytes"] or 0) <= broadcast_budget(points)}
    place = F.struct(F.col("_s").alias("s"), F.col("_s_lat").alias("a"), F.col("_s_lon").alias("o"))
    where = st.select(F.col(date_col).alias("_s_date"), F.col(station_col).alias("_s"), F.col(st_lat).alias("_s_lat"),
                      F.col(st_lon).alias("_s_lon"))
    level = first_level(known["busiest"] or 0, known["lat_span"] or 0.0, known["lon_span"] or 0.0)
    if level is not None and not paired:
        # dates are bounded by the calendar: one value for each day on which any station reports
        dates = st.agg(F.array_sort(F.collect_set(date_col)).alias("dates")).scalar()
        points = points.distinct().withColumn(date_col, F.explode(dates))
    by_place = [F.col(lat_col).alias("_lat"), F.col(lon_col).alias("_lon")]
    if level is None and not paired:
        found = nearest_by_order(points.select(*by_place).distinct(), where, place,
                                 fits(n_points, 0, points), fits(n_points * n_places, known["name"] or 0, points))
    else:  # a pair looks at nine cells at a time
        asked = points.select(F.col(date_col).alias("_date"), *by_place).distinct()
        found = nearest_found(asked, where, level, place, fits(9 * pairs, 0, points))
    near = found.select(F.col("_date").alias(date_col), F.col("_lat").alias(lat_col), F.col("_lon").alias(lon_col),
                        F.col("_place.s").alias("_n_station"), F.col("_place.a").alias("_n_lat"),
                        F.col("_place.o").alias("_n_lon"), "distance_km")
    keys = [date_col, station_col, st_lat, st_lon]
    rest = [c for c in st.columns if c not in keys]
    readings = (st.groupBy(*keys).agg(F.min(F.struct(F.lit(0).alias("_"), *rest)).alias("_r"))
                .select(F.col(date_col).alias("_r_date"), station_col, st_lat, st_lon,
                        *[F.col(f"_r.{c}").alias(c) for c in rest]))
    return NearestSide(near, readings, small)


def attach_nearest(trips: DataFrame, side: NearestSide, date_col: str = "date", lat_col: str = "PU_lat",
                   lon_col: str = "PU_lon") -> DataFrame:
    """Every trip with the readings of the nearest station that reports on its date.

    Trips without one keep null readings.  On a name clash the station's column
    wins.  Tables within the broadcast budget are broadcast, so the trips are
    read once and not shuffled; larger ones are shuffled joins.
    """
    found = [c for c in side.readings.columns if not c.startswith("_r_")]
    left = trips.drop(*[c for c in [*found, "distance_km"] if c in trips.columns and c not in (date_col, lat_col, lon_col)])

    def table(name):
        df = getattr(side, name)
        return F.broadcast(df) if side.small[name] else df

    station, lat, lon = found[:3]
    left = left.join(table("near").withColumnRenamed("distance_km", "_n_km"), [date_col, lat_col, lon_col], "left")
    near = left.join(table("readings"), (F.col(date_col) == F.col("_r_date")) & F.col("_n_station").eqNullSafe(F.col(station))
                     & (F.col("_n_lat") == F.col(lat)) & (F.col("_n_lon") == F.col(lon)), "left")
    return near.withColumn("distance_km", F.col("_n_km")).drop("_n_station", "_n_lat", "_n_lon", "_n_km", "_r_date")


def nearest_station_join(trips: DataFrame, stations: DataFrame, date_col: str = "date", lat_col: str = "PU_lat",
                         lon_col: str = "PU_lon", station_col: str = "station", st_lat: str = "lat",
                         st_lon: str = "lon", points: DataFrame | None = None) -> DataFrame:
    """Every trip with the readings of the nearest station that reports on its pickup date.

    ``points``: the table the trips' pickup coordinates come from (columns
    ``lat_col``, ``lon_col``); without it the trips are read once more for
    their distinct dates and points.  See ``nearest_side`` and ``attach_nearest``.
    """
    if points is None:
        points = write_once(trips.select(date_col, lat_col, lon_col).distinct(), "pickup-points")
    side = nearest_side(points, stations, date_col, lat_col, lon_col, station_col, st_lat, st_lon)
    return attach_nearest(trips, side, date_col, lat_col, lon_col)
