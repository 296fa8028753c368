"""The nearest reporting station of (date, point) pairs, by a grid index over station days.

The globe is cut into square cells of ``360 / 2^k`` degrees.  A pair looks at the
3 x 3 cells around its point in the stations of its date (an equi join on date and
cell), and the nearest station found is final when it is nearer than anything
outside those cells can be; else the pair goes on with cells of four times the
side, up to one round in which every station of the date is looked at.  So no
row or task holds all stations, a round's rows are the stations around the pairs
that are still open, and the result is exact.

What lies outside the 3 x 3 cells differs by at least a cell's side in latitude or
longitude.  The ellipsoid encloses the sphere of its polar radius, and projecting a
path onto that sphere shortens it, so the distance is at least that sphere's,
between geocentric latitudes; ``reach_km`` is that bound.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.functions.geo import geodesic_km
from skyfare.operators.sizing import broadcast_budget
from skyfare.session import write_once

#: Cells of the finest grid have 360 / 2^FINEST degrees; from COARSEST on a round looks at whole dates.
FINEST, COARSEST, STEP = 16, 3, 2
#: Station days of a date that are looked at without cells.
WHOLE_DATE = 64
#: Stations that the first round's 3 x 3 cells should hold, about.
AROUND = 9
POLAR_KM = 6356.752314245
#: Least ratio of geocentric to geodetic differences of latitude: (1 - f)^2 on WGS-84.
FLATTENED = (1 - 1 / 298.257223563) ** 2
#: Shares that the points are dealt over when all places are ranked for each point.
SHARES = 16
#: Bytes of a found pair besides the station's name.
FOUND_BYTES = 80


def side_degrees(level: int) -> float:
    return 360.0 / 2 ** level


def reach_km(lat: Column, level: int) -> Column:
    """What is outside the 3 x 3 cells around a point at ``lat`` is at least so far away."""
    side = math.radians(side_degrees(level))
    along = F.lit(FLATTENED * side)
    # the nearest point of a meridian that is ``side`` away; the cosine of the geodetic latitude is the smaller one
    across = F.asin(F.greatest(F.cos(F.radians(lat)), F.lit(0.0)) * math.sin(side))
    return F.least(along, across) * POLAR_KM * 0.9999  # the distance formula is good to a millionth


def _cell(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    side = side_degrees(level)
    row = F.floor((lat + 90) / side)
    return row, F.pmod(F.floor((lon + 180) / side), F.lit(2 ** level))


def first_level(busiest: int, lat_span: float, lon_span: float) -> int | None:
    """Level of the first round for ``busiest`` stations a date over an area in degrees; None: whole dates at once."""
    if busiest <= WHOLE_DATE:
        return None
    side = math.sqrt(max(lat_span, 1e-3) * max(lon_span, 1e-3) / busiest * AROUND) / 3
    level = min(FINEST, int(math.log2(360.0 / side)))
    return level if level > COARSEST else None


def nearest_found(pairs: DataFrame, stations: DataFrame, level: int | None, place: Column,
                  pairs_small: bool = False) -> DataFrame:
    """(date, lat, lon) of ``pairs`` with the nearest station: station, at, on, distance_km.

    ``pairs``: distinct _date, _lat, _lon.  ``stations``: _s_date, _s_lat, _s_lon and
    the fields of ``place``, a struct (s: name, a: lat, o: lon).  Distances are
    rounded to 1e-6 km; ties go to the smaller name, then place.  Pairs without a
    station on their date give no row.  ``pairs_small``: broadcast them in the
    rounds with cells, so that station days are not shuffled.
    """
    keys = ["_date", "_lat", "_lon"]
    km = F.round(geodesic_km("_lat", "_lon", "_s_lat", "_s_lon"), 6)
    best = F.min(F.struct(km.alias("distance_km"), place.alias("place"))).alias("_best")
    todo, done = pairs, []
    while level is not None and level > COARSEST:
        row, column = _cell(F.col("_lat"), F.col("_lon"), level)
        near = F.array(*[F.struct((row + i).alias("_row"), F.pmod(column + j, F.lit(2 ** level)).alias("_column"))
                         for i in (-1, 0, 1) for j in (-1, 0, 1)])
        asked = todo.select(*keys, F.explode(near).alias("_c")).select(*keys, "_c.*")
        s_row, s_column = _cell(F.col("_s_lat"), F.col("_s_lon"), level)
        there = stations.withColumns({"_s_row": s_row, "_s_column": s_column})
        asked = F.broadcast(asked) if pairs_small else asked
        met = there.join(asked, (F.col("_s_date") == F.col("_date")) & (F.col("_s_row") == F.col("_row"))
                         & (F.col("_s_column") == F.col("_column")))
        found = met.groupBy(*keys).agg(best).filter(F.col("_best.distance_km") < reach_km(F.col("_lat"), level))
        found = write_once(found, f"nearest-level-{level}")
        done.append(found)
        todo = write_once(todo.join(F.broadcast(found.select(*keys)) if pairs_small else found.select(*keys), keys, "left_anti"),
                          f"nearest-open-{level}")
        level -= STEP
        if todo.isEmpty():
            break
    else:
        asked = F.broadcast(todo) if pairs_small else todo
        met = stations.join(asked, F.col("_s_date") == F.col("_date"))
        done.append(met.groupBy(*keys).agg(best))
    found = reduce(DataFrame.unionByName, done)
    return found.select(*keys, F.col("_best.place").alias("_place"), F.col("_best.distance_km").alias("distance_km"))


def nearest_by_order(points: DataFrame, stations: DataFrame, place: Column, points_small: bool,
                     order_small: bool) -> DataFrame:
    """As ``nearest_found`` without cells, for all dates of ``stations`` and distinct ``points`` (_lat, _lon).

    A distance does not depend on the date, so the places are ranked once for
    each point, and a date takes the least rank among the stations that report.
    For few stations a date; the rows are points x places, two small tables.
    """
    places = stations.select(place.alias("_place")).distinct()
    # points are dealt over shares and the places copied to each: a join on the share, not on one key
    dealt = points.withColumn("_share", F.pmod(F.xxhash64("_lat", "_lon"), F.lit(SHARES)).cast("int"))
    copied = places.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    around = copied.join(F.broadcast(dealt) if points_small else dealt, "_share")
    km = F.round(geodesic_km("_lat", "_lon", "_place.a", "_place.o"), 6)
    rank = F.row_number().over(Window.partitionBy("_lat", "_lon").orderBy("distance_km", "_place"))
    order = around.withColumn("distance_km", km).withColumn("_rank", rank).drop("_share")
    if not order_small:
        order = write_once(order, "nearest-order")
    ranked = order.select(F.col("_place").alias("_at"), "_lat", "_lon", "_rank")
    days = stations.select("_s_date", place.alias("_here"))
    met = days.join(F.broadcast(ranked) if order_small else ranked, F.col("_here") == F.col("_at"))
    least = met.groupBy(F.col("_s_date").alias("_date"), "_lat", "_lon").agg(F.min("_rank").alias("_rank"))
    return least.join(F.broadcast(order) if order_small else order, ["_lat", "_lon", "_rank"]).select(
        "_date", "_lat", "_lon", "_place", "distance_km")


def fits(rows: int, name_bytes: int, df: DataFrame) -> bool:
    """Whether a table of so many found pairs fits the broadcast budget."""
    return rows * (FOUND_BYTES + name_bytes) <= broadcast_budget(df)
