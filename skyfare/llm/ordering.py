"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfare.session import write_once

#: ``monotonically_increasing_id`` has the partition above and the row within it below this bit.
ROW_BITS = 33


def with_places(df: DataFrame, order: list, name: str, place: str = "place") -> DataFrame:
    """``df`` with a column ``place``: the number of rows before it by ``order``, from 0.

    The rows are dealt by range, sorted inside each range and written once; the
    sizes of the ranges (one row for each) give where each range starts.  ``df``
    is read twice, once to find the ranges, so it should be a cheap frame.  Rows
    equal in ``order`` stand in any order among themselves, but keep it, since
    what was written is not sorted again.  A value of ``order`` that many rows
    share is one range: add columns that tell its rows apart.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = write_once(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                      .withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", ROW_BITS)
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = (rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
              .select("__part", F.coalesce(before, F.lit(0)).alias("__start")))
    # one row for each range, so its size does not grow with the rows
    found = rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
    row = F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return found.withColumn(place, row + F.col("__start")).drop("__at", "__part", "__start")
