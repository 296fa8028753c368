"""Zone lookup table: LocationID, Borough, Zone, service_zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE_SCHEMA = "LocationID STRING, Borough STRING, Zone STRING, service_zone STRING"


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV (header) -> typed zones; ids that do not parse are dropped."""
    raw = spark.read.option("header", True).schema(ZONE_SCHEMA).csv(path)
    return type_zones(raw)


def type_zones(raw: DataFrame) -> DataFrame:
    return (raw.select(F.col("LocationID").cast("string").try_cast("int").alias("LocationID"),
                       "Borough", "Zone", "service_zone")
               .where(F.col("LocationID").isNotNull()))
