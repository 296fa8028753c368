"""Weather station files.

A monthly file holds one object: station name -> list of day records, written
with single quotes.  Each file is one text row (``wholetext``); ``from_json``
with a declared map schema parses it and ``explode`` + ``inline`` turn it into
one row per (station, day).  Every station of a file is kept.

A file is one month of one weather site, so a single file stays small; the
work over many files spreads across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfare.functions.numeric import try_double

# The day-record fields, in the order the weather site lists them.
WEATHER_FIELDS = [
    "date", "tempMax", "tempMin", "tempAvg", "tempDeparture",
    "hdd", "cdd", "precipitation", "newSnow", "snowDepth",
]
NUMERIC_WEATHER_FIELDS = WEATHER_FIELDS[1:]

DAY_STRUCT = T.StructType([T.StructField(f, T.StringType(), True) for f in WEATHER_FIELDS])
DOC_SCHEMA = T.MapType(T.StringType(), T.ArrayType(DAY_STRUCT))


def read_weather_files(spark: SparkSession, path) -> DataFrame:
    """Weather file(s) -> one text row per file -> station rows (text fields)."""
    docs = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return parse_weather_docs(docs, "value", "path")


def parse_weather_docs(docs: DataFrame, text_col: str = "value", name_col: str | None = None) -> DataFrame:
    """Text column of station->days objects -> (station, date, tempMax, ...) text rows.

    A document that does not parse fails the job, with its name (``name_col``)
    and its first characters; a null or blank one has no stations.
    """
    doc = F.from_json(F.col(text_col), DOC_SCHEMA, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    name = F.col(name_col) if name_col else F.lit("(no name)")
    unreadable = F.raise_error(F.concat(F.lit("unreadable weather document "), name, F.lit(": "),
                                        F.substring(text_col, 1, 80))).cast(DOC_SCHEMA)
    blank = F.coalesce(F.trim(F.col(text_col)), F.lit("")) == ""
    parsed = docs.select(F.when(blank, F.lit(None).cast(DOC_SCHEMA)).when(doc.isNull(), unreadable)
                         .otherwise(doc).alias("doc"))
    per_station = parsed.select(F.explode("doc").alias("station", "days"))
    return per_station.select("station", F.inline("days"))


def type_station_rows(rows: DataFrame) -> DataFrame:
    """Text station rows -> typed: ``date`` as DATE, readings as DOUBLE.

    Cells such as 'M' (missing) or 'T' (trace) become null.
    """
    exprs = [F.col("station"), F.col("date").cast("string").try_cast("date").alias("date")]
    exprs += [try_double(f).alias(f) for f in NUMERIC_WEATHER_FIELDS]
    others = [c for c in rows.columns if c not in set(WEATHER_FIELDS) | {"station"}]
    return rows.select(*exprs, *others)


def filter_station(rows: DataFrame, term: str = "NY", col: str = "station") -> DataFrame:
    """Keep stations whose name contains ``term``."""
    return rows.where(F.col(col).contains(term))


def encode_weather_docs(day_rows: DataFrame, group_col: Column | str) -> DataFrame:
    """Inverse of ``parse_weather_docs``: text day rows -> one single-quoted object per group.

    Used to lay out monthly files from station-day rows.  A group is one month,
    so its size is bounded by stations x days.
    """
    group = F.col(group_col) if isinstance(group_col, str) else group_col
    days = F.struct(*[F.col(f).cast("string").alias(f) for f in WEATHER_FIELDS])
    per_station = (day_rows.groupBy(group.alias("doc_key"), F.col("station"))
                   .agg(F.array_sort(F.collect_list(days)).alias("days")))
    per_doc = (per_station.groupBy("doc_key")
               .agg(F.map_from_entries(F.collect_list(F.struct("station", "days"))).alias("doc")))
    text = F.to_json("doc")
    # quotes and backslashes inside names become character codes, then the quotes of the syntax become single
    for old, new in (("\\\\", "\\u005c"), ('\\"', "\\u0022"), ("'", "\\u0027"), ('"', "'")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return per_doc.select("doc_key", text.alias("value"))
