"""Size checks that guard every broadcast.

A side is broadcast only after its rows and real byte lengths have been added
up, in one partially aggregated pass; each task sends one row of sums.  Anything
above the budget is joined by a shuffle, where AQE splits skewed partitions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_BYTES_CONF = "skyfare.broadcast.maxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: What a row, and each column of it, takes besides its own bytes.
ROW_BYTES, COLUMN_BYTES = 32, 16


@dataclass
class Size:
    rows: int
    bytes: int


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df``: real lengths of texts, nested values by their JSON text."""
    total = F.lit(ROW_BYTES + COLUMN_BYTES * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return total.cast("long")


def measure(df: DataFrame) -> Size:
    """Rows and bytes of ``df``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def broadcast_budget(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(BROADCAST_MAX_BYTES_CONF, None)
    return int(conf) if conf else DEFAULT_BROADCAST_MAX_BYTES


def checked_count(df: DataFrame, max_bytes: int | None = None) -> int | None:
    """Row count when ``df`` fits the broadcast budget by its measured bytes, else None."""
    size = measure(df)
    return size.rows if size.bytes <= (broadcast_budget(df) if max_bytes is None else max_bytes) else None


def concurrently(jobs: list) -> list:
    """Results of independent callables, each a small Spark job, run from separate driver threads."""
    if len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return list(pool.map(lambda job: job(), jobs))


def checked_counts(dfs: list[DataFrame], max_bytes: int | None = None) -> list[int | None]:
    """``checked_count`` of several independent inputs, submitted as concurrent jobs."""
    return concurrently([lambda d=d: checked_count(d, max_bytes) for d in dfs])


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """(broadcast(df), True) when df fits ``max_bytes``; else (df, False)."""
    if checked_count(df, max_bytes) is None:
        return df, False
    return F.broadcast(df), True
