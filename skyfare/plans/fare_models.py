"""Fare models over the merged trips: rows, split, OLS, forward selection, forest, network."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyfare.operators import clean, ml
from skyfare.session import write_once

FEATURES = ["trip_distance", "passenger_count", "weather"]
LABEL = "total_amount"
KEY = ["trip_id"]


def model_rows(merged: DataFrame, fill: bool = True) -> DataFrame:
    """Merged trips -> (trip_id, features, label, fare_amount); nulls -> 0 when ``fill``."""
    df = clean.rename_columns(merged, {"tempAvg": "weather"}).select(
        "trip_id", *FEATURES, LABEL, "fare_amount")
    df = clean.cast_features(df, FEATURES + [LABEL, "fare_amount"])
    return clean.fill_zero(df) if fill else df


def written_rows(merged: DataFrame, fill: bool = True) -> DataFrame:
    """``model_rows`` written once to the shared scratch folder.

    Fits read their rows several times (gram sums, then scoring; scaler
    statistics, then scaling; every epoch or fold).  Without this each pass
    would re-run the whole merge -- scans, zone joins, nearest station.
    """
    return write_once(model_rows(merged, fill), "model-rows")


def split(rows: DataFrame):
    return ml.train_test_split(rows, KEY)
