"""Trip files: CSV with a header row, every column read as text, then typed once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skyfare.functions.dates import pickup_date

# The green-trip column names and the pickup/dropoff column names.
PICKUP_COL = "lpep_pickup_datetime"
DROPOFF_COL = "lpep_dropoff_datetime"
ID_COLUMNS = ["PULocationID", "DOLocationID"]
TRIP_KINDS = ["green", "yellow"]
NUMERIC_COLUMNS = [
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "payment_type", "trip_type",
]


def scan_trips(spark: SparkSession, path, pickup_col: str = PICKUP_COL) -> DataFrame:
    """Read trip CSV file(s) of one kind with a header and type them (see ``type_trips``).

    A file whose header differs from the others fails the job instead of
    shifting its values into the wrong columns.
    """
    raw = _csv(spark, path)
    return type_trips(raw, pickup_col=pickup_col)


def type_trips(raw: DataFrame, pickup_col: str = PICKUP_COL) -> DataFrame:
    """Text trip columns -> typed columns plus the pickup ``date``.

    Zone ids become int and the known numeric columns double; a cell that does
    not parse becomes null instead of failing the job.  Timestamp columns stay
    text (``trip_duration`` parses them with their own format).  Columns we do
    not know pass through unchanged.  ``date`` is 1970-01-01 when the pickup
    time is missing or unparseable.
    """
    present = set(raw.columns)
    exprs = []
    for name in raw.columns:
        if name in ID_COLUMNS:
            exprs.append(F.col(name).cast("string").try_cast("int").alias(name))
        elif name in NUMERIC_COLUMNS:
            exprs.append(F.col(name).cast("string").try_cast("double").alias(name))
        elif name == "trip_id":
            exprs.append(F.col(name).cast("string").try_cast("bigint").alias(name))
        else:
            exprs.append(F.col(name))
    pickup = F.col(pickup_col) if pickup_col in present else F.lit(None).cast("string")
    exprs.append(pickup_date(pickup).alias("date"))
    return raw.select(*exprs)


def month_list(start: str, end: str) -> list[str]:
    """'YYYY-MM' .. 'YYYY-MM' inclusive, as 'YYYY/MM' strings (bounded by the range)."""
    y, m = (int(x) for x in start.split("-"))
    ey, em = (int(x) for x in end.split("-"))
    out = []
    while (y, m) <= (ey, em):
        out.append(f"{y:04d}/{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def scan_month_range(spark: SparkSession, root: str, start: str, end: str,
                     layout: str = "plain", fmt: str = "csv",
                     empty_schema: str | None = None,
                     kinds: Sequence[str] | None = None) -> DataFrame:
    """All trip files of the months ``start``..``end`` under ``root``.

    ``layout="plain"``: files live in ``root/YYYY/MM/``.  Only those month
    folders are listed (one glob with alternation), so other months are never
    opened; ``year`` and ``month`` come from each row's file path.

    ``kinds``: file-name prefixes of trip files with different columns kept
    side by side in a month folder (``TRIP_KINDS``: green and yellow).  One
    CSV read applies a single header to every file it opens, so each kind is
    read on its own, with its own header, and the kinds are combined by column
    name; a column a kind lacks is null (yellow rows have no
    ``lpep_pickup_datetime``).  ``trip_kind`` names the kind of each row.
    None: every file in one read, which fails if their headers differ.

    ``layout="hive"``: ``root/year=YYYY/month=M/`` as written by
    ``append_partitioned``; the month filter prunes partitions.
    """
    months = month_list(start, end)
    if layout == "hive":
        df = spark.read.format(fmt).load(root)
        key = F.col("year") * 100 + F.col("month")
        lo = int(start.replace("-", ""))
        hi = int(end.replace("-", ""))
        return df.where((key >= lo) & (key <= hi))
    folders = root.rstrip("/") + "/{" + ",".join(months) + "}/"
    parts = []
    for kind in (kinds or [None]):
        raw = _read_files(spark, folders + ("*" if kind is None else f"{kind}*"), fmt)
        if raw is None:
            continue
        path = F.col("_metadata.file_path")
        extra = [F.regexp_extract(path, r"/(\d{4})/(\d{2})/[^/]*$", 1).cast("int").alias("year"),
                 F.regexp_extract(path, r"/(\d{4})/(\d{2})/[^/]*$", 2).cast("int").alias("month")]
        if kind is not None:
            extra.append(F.lit(kind).alias("trip_kind"))
        parts.append(raw.select("*", *extra))
    if not parts:
        # no month folder of the range holds a file
        if empty_schema is None:
            raise FileNotFoundError(f"no trip files under {folders}")
        kind_col = ", trip_kind STRING" if kinds else ""
        return spark.createDataFrame([], empty_schema + ", year INT, month INT" + kind_col)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _csv(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _read_files(spark: SparkSession, pattern: str, fmt: str) -> DataFrame | None:
    """The files matching ``pattern`` (CSV with its header), or None when there are none."""
    try:
        return _csv(spark, pattern) if fmt == "csv" else spark.read.format(fmt).load(pattern)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
