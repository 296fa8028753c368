"""Trips + zones + weather -> one row per trip with the nearest station's readings.

scan/type trips -> pickup zone (inner) -> dropoff zone (inner)
weather rows -> station coordinates -> nearest station of the same date (left)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.operators.enrich import (NearestSide, attach_nearest, geocode_lookup, join_dropoff_zone,
                                      join_pickup_zone, nearest_side, zone_points)
from skyfare.operators.sizing import broadcast_budget, checked_counts, concurrently, measure
from skyfare.session import write_once
from skyfare.sources import proxies
from skyfare.sources.trips import type_trips
from skyfare.sources.weather import encode_weather_docs, parse_weather_docs, type_station_rows


def locate_trips(trips: DataFrame, zones: DataFrame, zone_geocodes: DataFrame) -> DataFrame:
    """Typed trips -> trips with pickup and dropoff coordinates (unknown zone ids dropped)."""
    # points are 1:1 with zones (left join on de-duplicated geocodes) and narrower, so the
    # measured zone table bounds them; the two checks run as concurrent jobs
    n_geo, n_points = checked_counts([zone_geocodes, zones])
    points = zone_points(zones, zone_geocodes, geocodes_small=n_geo is not None)
    small = n_points is not None
    return join_dropoff_zone(join_pickup_zone(trips, points, small), points, small)


def locate_stations(station_rows: DataFrame, station_geocodes: DataFrame) -> DataFrame:
    """Typed station rows -> with station (lat, lon); unknown names at (0.0, 0.0)."""
    return geocode_lookup(station_rows, "station", station_geocodes)


@dataclass
class StaticSide:
    """The small derived tables every trip is joined with, written once."""
    points: DataFrame          # (LocationID, lat, lon)
    points_small: bool         # verdict of the size check
    nearest: NearestSide       # nearest station of each date and point, readings


def prepare_static(zones: DataFrame, zone_geocodes: DataFrame, station_rows: DataFrame,
                   station_geocodes: DataFrame, write_nearest: bool = False) -> StaticSide:
    """Zone points, located stations and the tables of the nearest-station join.

    Points and stations are read by several branches, so they are written once
    to the shared folder, and their sizes are measured there; independent jobs
    run concurrently.  ``write_nearest``: write the join's two tables too, for
    callers that join them many times (a stream's micro-batches).
    """
    n_zone_geo, n_station_geo = checked_counts([zone_geocodes, station_geocodes])
    pts = zone_points(zones, zone_geocodes, geocodes_small=n_zone_geo is not None)
    st = geocode_lookup(station_rows, "station", station_geocodes,
                        geocodes_small=n_station_geo is not None)
    points, stations = concurrently([lambda: write_once(pts, "zone-points"), lambda: write_once(st, "stations")])
    size = measure(points)
    near = nearest_side(points.select(F.col("lat").alias("PU_lat"), F.col("lon").alias("PU_lon")), stations,
                        n_points=size.rows)
    if write_nearest:
        tables = concurrently([lambda n=n: write_once(getattr(near, n), f"nearest-{n}")
                               for n in ("near", "readings")])
        near = NearestSide(*tables, near.small)
    return StaticSide(points, size.bytes <= broadcast_budget(points), near)


def enrich_trips(trips: DataFrame, side: StaticSide) -> DataFrame:
    """Typed trips -> located (inner zone joins) -> nearest station of the pickup date.

    The trips are read once; with every table in the broadcast budget they are not shuffled.
    """
    located = join_dropoff_zone(join_pickup_zone(trips, side.points, side.points_small),
                                side.points, side.points_small)
    return attach_nearest(located, side.nearest)


def merge_trips_weather(trips: DataFrame, zones: DataFrame, zone_geocodes: DataFrame,
                        station_rows: DataFrame, station_geocodes: DataFrame) -> DataFrame:
    """Every located trip with the readings of the nearest station on its date."""
    return enrich_trips(trips, prepare_static(zones, zone_geocodes, station_rows, station_geocodes))


# ---- the same job over the stand-in tables -------------------------------------------------

def proxy_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_trips(proxies.trip_text(spark, sf_dir))


def proxy_station_rows(spark: SparkSession, sf_dir: str, via_files: bool = True) -> DataFrame:
    """Typed station rows.  ``via_files``: through the monthly-file text form and back
    (what reading weather files does); otherwise typed straight from the day rows."""
    days = proxies.station_day_text(spark, sf_dir)
    if not via_files:
        return type_station_rows(days)
    docs = encode_weather_docs(days, F.substring("date", 1, 7))
    return type_station_rows(parse_weather_docs(docs, "value"))
