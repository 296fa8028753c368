"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.operators.sizing import broadcast_budget
from skyfare.session import ship_package, write_once

#: Arrow batches are cut to about so many bytes of text before Python objects are made of them.
SLICE_BYTES = 2 << 20


def prepare(df: DataFrame) -> SparkSession:
    """The frame's session, with this package shipped to its Python workers."""
    spark = df.sparkSession
    ship_package(spark)
    return spark


_STATE: dict = {}


def worker_state(key, make):
    """What ``make()`` gave for ``key`` in this worker process; only the last key's is kept.

    Workers outlive a task, so tokenizers and their memories of words are made
    once; the operator that comes next frees those of the one before.
    """
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]


def slices(batches, text: str = "text", limit: int = SLICE_BYTES):
    """Arrow batches cut to at most ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            end = max(at + 1, int(size.searchsorted(base + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def text_bytes(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """The column's texts; null counts as empty.

    Spark reads texts of invalid UTF-8 without complaint.  Where characters are
    needed, each invalid sequence of bytes reads as U+FFFD.
    """
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [x.decode(errors="replace") for x in text_bytes(column)]


def valid_texts(column: pa.Array) -> pa.Array:
    """The texts of ``texts`` as an Arrow array."""
    try:
        column.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array(texts(column), column.type)
    return column.fill_null("")


def joined_on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe equi join on columns of the same name; the keys come once, from the left."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [left[k].eqNullSafe(other[f"__r_{k}"]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(other, cond, how).drop(*[f"__r_{k}" for k in keys])


def rows_of_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """Rows of ``docs`` whose id is (left_semi) or is not (left_anti) among ``ids``.

    The ids are counted; while they fit the broadcast budget the texts stay
    where they are, beyond that both sides are shuffled on the id.
    """
    ids = ids.select(id_col).distinct()
    kind = dict(ids.dtypes)[id_col]
    stats = ids.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.octet_length(F.col(id_col).cast("string"))).alias("b")).first()
    size = stats["n"] * 80 + (stats["b"] or 0 if kind == "string" else 0)
    if size <= broadcast_budget(docs):
        ids = F.broadcast(ids)
    return joined_on(docs, ids, [id_col], how)


def keep_decided(docs: DataFrame, id_col: str, decide) -> DataFrame:
    """Rows of ``docs`` that ``decide`` keeps, with all their columns.

    ``decide(rows, key)`` returns (key, kept) for each row.  The key is the id
    while ids are unique and not null; else rows get keys of their own, ordered
    by id (null last), and then by place.
    """
    seen = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if seen.filter((F.col("n") > 1) | F.col(id_col).isNull()).isEmpty():
        return rows_of_ids(docs, decide(docs, id_col).filter("not kept"), id_col, "left_anti")
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   F.monotonically_increasing_id().alias("place"))
    keyed = write_once(docs.withColumn("__row", key), "keyed-rows")
    return rows_of_ids(keyed, decide(keyed, "__row").filter("not kept"), "__row", "left_anti").drop("__row")


#: A class with more than this share of all members is joined by broadcast, so there are at most so many of them.
HOT_CLASSES = 1000


def join_by_class(members: DataFrame, classes: DataFrame, key: str, size_col: str) -> DataFrame:
    """Inner join of many ``members`` with the one row of their class.

    ``size_col`` has the number of members of each class.  Classes with at least
    a thousandth of all members, a thousand rows at most, are broadcast; only
    members of smaller classes are shuffled on the key.
    """
    total = classes.agg(F.sum(size_col)).first()[0] or 0
    hot = classes.filter(F.col(size_col) * HOT_CLASSES >= total)
    cold = classes.filter(F.col(size_col) * HOT_CLASSES < total)
    return (members.join(F.broadcast(hot), key)
            .unionByName(members.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)))
