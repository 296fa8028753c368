"""Stand-ins for trip, zone, geocode and station data, derived by Spark from the
driver's tables.  Each one grows with its source table.

trip         orders join customer (o_orderkey is unique)
zone         nation join region
geocode      a rule over the nation key; some names are left out on purpose
station day  events grouped by (day, user_id mod 4): every event is a reading
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.operators.sizing import broadcast_if_small
from skyfare.session import table_path
from skyfare.sources.weather import WEATHER_FIELDS

# Fixed values for the stand-ins.
TRIP_BASE_DATE = _dt.date(2024, 1, 1)
TRIP_DATE_SPAN_DAYS = 40          # trips spread over 40 days; stations cover 30
ORDER_EPOCH = _dt.date(1995, 1, 1)
STATION_NAMES = ["CENTRAL PARK NY", "LAGUARDIA AIRPORT NY", "JFK AIRPORT NY",
                 "NEWARK AIRPORT NJ"]
DOLOCATION_MOD = 27               # ids 25 and 26 have no zone
MISSING_GEOCODE_SUFFIX = "3"      # zone names ending in 3 have no geocode


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def broadcast_checked(df: DataFrame) -> DataFrame:
    """``df`` (a projection of a driver table) behind a size check."""
    return broadcast_if_small(df)[0]


def trip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as a header CSV would load them: every column text."""
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    c = broadcast_checked(c)
    t = o.join(c, o.o_custkey == c.c_custkey, "inner")
    day = F.pmod(F.datediff(F.to_date("o_orderdate"), F.lit(ORDER_EPOCH)), F.lit(TRIP_DATE_SPAN_DAYS))
    secs = F.pmod(F.col("o_orderkey") * 7919, F.lit(86400))
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")     # zone-free literal
    pickup = F.timestamp_add("SECOND", day * 86400 + secs, base)
    dropoff = F.timestamp_add("SECOND", F.pmod(F.col("o_custkey"), F.lit(3000)) + 60, pickup)
    broken = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return t.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.when(broken, F.lit("n/a")).otherwise(F.date_format(pickup, fmt)).alias("lpep_pickup_datetime"),
        F.when(broken, F.lit("")).otherwise(F.date_format(dropoff, fmt)).alias("lpep_dropoff_datetime"),
        F.col("c_nationkey").cast("string").alias("PULocationID"),
        F.pmod(F.col("o_orderkey"), F.lit(DOLOCATION_MOD)).cast("string").alias("DOLocationID"),
        (F.pmod(F.col("o_orderkey"), F.lit(6)) + 1).cast("string").alias("passenger_count"),
        (F.col("o_totalprice") / F.lit(10000.0)).cast("string").alias("trip_distance"),
        (F.col("o_totalprice") / F.lit(100.0)).cast("string").alias("fare_amount"),
        ((F.col("o_totalprice") + F.col("c_acctbal")) / F.lit(100.0)).cast("string").alias("total_amount"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed zones: LocationID int, Borough, Zone, service_zone."""
    n = read(spark, sf_dir, "nation")
    r = broadcast_checked(read(spark, sf_dir, "region"))
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
             .select(F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"), F.lit("Boro Zone").alias("service_zone")))


def zone_geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(place, lat, lng) for zone names; a few names are absent on purpose."""
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return (n.where(~F.col("n_name").endswith(MISSING_GEOCODE_SUFFIX))
             .select(F.col("n_name").alias("place"),
                     (F.lit(40.5) + F.pmod(k, F.lit(5)).cast("double") * F.lit(0.1)).alias("lat"),
                     (F.lit(-74.2) + F.floor(k / 5).cast("double") * F.lit(0.1)).alias("lng")))


def station_geocodes(spark: SparkSession) -> DataFrame:
    """(place, lat, lng) for the stand-in stations (a fixed four-row table)."""
    rows = [(name, 40.55 + j * 0.13, -74.15 + ((j * 3) % 4) * 0.11)
            for j, name in enumerate(STATION_NAMES)]
    return spark.createDataFrame(rows, "place STRING, lat DOUBLE, lng DOUBLE")


def station_day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-day rows with text cells, from events grouped by (day, user_id mod 4).

    Readings are kept in integer hundredths while aggregating, so the values are
    exact and do not depend on the order of summation.
    """
    e = read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    j = F.pmod(F.col("user_id"), F.lit(4)).cast("int")
    cents = F.round(F.col("value") * 100).cast("bigint")
    g = (e.groupBy(F.to_date("ts").alias("day"), j.alias("j"))
          .agg(F.max(cents).alias("cmax"), F.min(cents).alias("cmin"),
               F.sum(cents).alias("csum"), F.count(F.lit(1)).alias("n"),
               F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("n_err")))
    avg = F.col("csum").cast("double") / F.col("n").cast("double") / F.lit(100.0)
    names = F.element_at(F.array(*[F.lit(s) for s in STATION_NAMES]), F.col("j") + 1)
    cells = {
        "date": F.date_format("day", "yyyy-MM-dd"),
        "tempMax": (F.col("cmax").cast("double") / F.lit(100.0)).cast("string"),
        "tempMin": (F.col("cmin").cast("double") / F.lit(100.0)).cast("string"),
        "tempAvg": avg.cast("string"),
        "tempDeparture": (avg - F.lit(50.0)).cast("string"),
        "hdd": F.greatest(F.lit(65.0) - avg, F.lit(0.0)).cast("string"),
        "cdd": F.greatest(avg - F.lit(65.0), F.lit(0.0)).cast("string"),
        "precipitation": F.when(F.col("n_err") == 0, F.lit("T"))
                          .otherwise((F.col("n_err").cast("double") / F.lit(100.0)).cast("string")),
        "newSnow": F.lit("M"),
        "snowDepth": F.lit("0"),
    }
    return g.select(names.alias("station"), *[cells[f].alias(f) for f in WEATHER_FIELDS])
