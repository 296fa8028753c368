"""Renames, casts, fills, keys, limits and other row-level cleaning operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names not present are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def cast_features(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Cast the listed columns (default: all) to double; text such as 'M' becomes null."""
    wanted = set(df.columns if cols is None else cols)
    return df.select(*[(F.col(c).cast("string").try_cast("double") if c in wanted
                        and not isinstance(df.schema[c].dataType, _NUMERIC)
                        else F.col(c).cast("double") if c in wanted else F.col(c)).alias(c)
                       for c in df.columns])


def fare_features(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """trip_distance (double), passenger_count (int), weather, total_amount AS fare."""
    return df.select(*keep,
                     F.col("trip_distance").cast("double").alias("trip_distance"),
                     F.col("passenger_count").cast("double").try_cast("int").alias("passenger_count"),
                     F.col("weather").cast("double").alias("weather"),
                     F.col("total_amount").cast("double").alias("fare"))


def fill_zero(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Null -> 0 in numeric columns (text columns stay null)."""
    cols = numeric_columns(df) if subset is None else [c for c in subset if c in numeric_columns(df)]
    return df.fillna(0, subset=cols) if cols else df


def drop_incomplete(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows holding any null (in ``subset`` or in all columns)."""
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def fill_zero_and_drop(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """``fill_zero`` then ``drop_incomplete`` over ``subset`` (default: all columns), in one step.

    Filled numeric columns hold neither null nor NaN, so only the other columns
    can still drop a row; checking just those gives the same rows with a null
    test over a few columns instead of every column.
    """
    numeric = set(numeric_columns(df))
    rest = [c for c in (df.columns if subset is None else subset) if c not in numeric]
    filled = fill_zero(df)
    return drop_incomplete(filled, rest) if rest else filled


def key_text(key_cols: Iterable[str]) -> Column:
    """The key columns as one text: '<length>:<text>' of each part, '-' for null."""
    parts = [F.col(c).cast("string") for c in key_cols]
    return F.concat(*[F.when(p.isNull(), F.lit("-")).otherwise(
        F.concat(F.length(p).cast("string"), F.lit(":"), p)) for p in parts])


def surrogate_id(df: DataFrame, key_cols: Iterable[str], out: str = "id") -> DataFrame:
    """Deterministic record key: SHA-256 of the key columns in an unambiguous form.

    Each part is written as its length and its text ('-' for null), so that
    neither separators inside a value nor null and '' make two keys equal.

    Unlike a per-file increasing id it does not restart per input file, so keys
    from different files do not collide, and a recomputed task yields the same keys.
    """
    return df.withColumn(out, F.sha2(key_text(key_cols), 256))


def raw_increasing_id(df: DataFrame, out: str = "id") -> DataFrame:
    """Spark's increasing id: unique within one DataFrame, not stable across runs."""
    return df.withColumn(out, F.monotonically_increasing_id())


def limit_rows(df: DataFrame, n: int, order_by: Iterable[str]) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order (a distributed top-n, no collect)."""
    return df.orderBy(*order_by).limit(n)


def month_station_grid(stations: DataFrame, start: str, end: str,
                       station_col: str = "station") -> DataFrame:
    """(station, year, month, month_key) for every month of ``start``..``end`` ('YYYY-MM').

    Each station row generates its months with ``sequence`` + ``explode``; no join.
    """
    first = F.to_date(F.lit(start + "-01"))
    last = F.to_date(F.lit(end + "-01"))
    months = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    return (stations.select(station_col).distinct()
                    .select(station_col, months.alias("_m"))
                    .select(station_col, F.year("_m").alias("year"),
                            F.lpad(F.month("_m").cast("string"), 2, "0").alias("month"),
                            F.date_format("_m", "yyyy_MM").alias("month_key")))


def overlay_columns(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on ``on``; when both sides have a column of the same name the right one wins."""
    clash = [c for c in right.columns if c in left.columns and c not in on]
    return left.drop(*clash).join(right, on, how)
