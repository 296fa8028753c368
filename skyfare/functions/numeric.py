from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_double(c) -> Column:
    """String (or any) column to double; text such as 'M' or 'T' becomes null.

    ANSI mode stays on, so a plain cast would raise on such cells.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")
