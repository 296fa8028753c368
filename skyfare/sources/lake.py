"""Tables in the lake: databases, reads, SQL, appends, upserts, deletes, partitioned writes.

Tables are Parquet.  A rewrite (upsert, delete) always goes to a new path and
never overwrites the path it reads; the caller swaps the pointer afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.operators.sizing import checked_count
from skyfare.session import write_once


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, then USE it (built-in catalog)."""
    ident = f"`{name.replace('`', '')}`"
    if location:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident} LOCATION '{location}'")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident}")
    spark.catalog.setCurrentDatabase(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table ``name`` (resolved by the catalog, never by string concatenation)."""
    return spark.table(name)


def raw_sql(spark: SparkSession, sql: str, args: Mapping | None = None) -> DataFrame:
    """Any Spark SQL, with named parameters (``:name``) bound from ``args``."""
    return spark.sql(sql, args=dict(args) if args else None)


def append_table(df: DataFrame, target: str, as_table: bool = False, fmt: str = "parquet") -> None:
    """Append rows to a path (default) or a catalog table.  No dedup: bulk insert."""
    writer = df.write.mode("append").format(fmt)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def append_partitioned(df: DataFrame, path: str, cols: Iterable[str], fmt: str = "parquet",
                       rebalance: bool = True) -> None:
    """Append into ``path/col=value/...`` folders; readers prune on those columns.

    A REBALANCE on the partition columns gathers each partition's rows into few
    tasks, so a partition gets files in proportion to its size instead of one
    file from every writing task.  AQE splits a partition holding a third of
    the rows into advisory-size tasks (never one task per partition) and merges
    small ones.  ``rebalance=False`` skips that shuffle for input already
    clustered by the partition columns (e.g. read from per-month folders).
    """
    cols = list(cols)
    out = df.hint("rebalance", *cols) if rebalance else df
    out.write.mode("append").partitionBy(*cols).format(fmt).save(path)


def _ordered(df: DataFrame, col: str):
    """The column in a form that can be compared and hashed (maps as text)."""
    kind = df.schema[col].dataType.simpleString()
    return F.to_json(F.struct(F.col(col))) if "map<" in kind or kind == "variant" else F.col(col)


def _latest(base: DataFrame, changes: DataFrame, key: list[str], sort_key: str) -> DataFrame:
    # max_by in a groupBy: every task combines its rows before the shuffle, so a key
    # with millions of versions is reduced map-side; the hash settles equal versions
    cols = list(base.columns)
    both = (base.select(*cols, F.lit(0).alias("_batch"))
                .unionByName(changes.select(*cols, F.lit(1).alias("_batch"))))
    order = F.struct(F.col(sort_key), F.col("_batch"), F.xxhash64(*[_ordered(base, c) for c in cols]))
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), order)
    return both.groupBy(*key).agg(best.alias("_w")).select(*[F.col(f"_w.{c}").alias(c) for c in cols])


def _same_key(key: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])


def upsert_rows(base: DataFrame, changes: DataFrame, key: Iterable[str], sort_key: str,
                changes_small: bool | None = None) -> DataFrame:
    """The base with the latest version of every key that ``changes`` touch.

    Of a touched key one row stays, the one with the largest ``sort_key`` over
    base and changes; on a tie the change wins.  Base rows of untouched keys
    stay as they are, also several rows of one key (bulk appends), as in a
    MERGE.  Keys compare null-safely (a null key is one key, as in a GROUP BY).

    ``changes_small`` (None: checked here) only chooses the plan: within the
    broadcast budget the touched keys are broadcast and the base is not
    shuffled; beyond it both joins shuffle on the key.
    """
    key = list(key)
    if changes_small is None:
        changes_small = checked_count(changes.select(*key)) is not None
    touched = changes.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct()
    if changes_small:
        touched = F.broadcast(touched)
    untouched = base.join(touched, _same_key(key), "left_anti")
    hit = base.join(touched, _same_key(key), "left_semi")
    return untouched.unionByName(_latest(hit, changes, key, sort_key))


def upsert_table(spark: SparkSession, base_path: str, changes: DataFrame, key: Iterable[str],
                 sort_key: str, out_path: str, fmt: str = "parquet") -> DataFrame:
    """Write the upserted table to ``out_path`` (never ``base_path``) and read it back.

    The changes are written once first: the check, the touched keys and the
    merge read them from there.
    """
    base = spark.read.format(fmt).load(base_path)
    changes = write_once(changes, "upsert-changes")
    upsert_rows(base, changes, key, sort_key).write.mode("overwrite").format(fmt).save(out_path)
    return spark.read.format(fmt).load(out_path)


def delete_rows(base: DataFrame, keys: DataFrame, key: Iterable[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``keys``; keys compare null-safely, as in ``upsert_rows``."""
    key = list(key)
    # the key rows bound their distinct keys, so the check scans them instead of
    # computing the distinct twice (once to measure, once to join)
    small = checked_count(keys.select(*key)) is not None
    k = keys.select(*[F.col(c).alias(f"_k_{c}") for c in key]).distinct()
    return base.join(F.broadcast(k) if small else k, _same_key(key), "left_anti")


def delete_by_key(spark: SparkSession, base_path: str, keys: DataFrame, key: Iterable[str],
                  out_path: str, fmt: str = "parquet") -> DataFrame:
    base = spark.read.format(fmt).load(base_path)
    delete_rows(base, keys, key).write.mode("overwrite").format(fmt).save(out_path)
    return spark.read.format(fmt).load(out_path)


def write_bucketed(df: DataFrame, table: str, key: Iterable[str], buckets: int, path: str,
                   gather: bool = True) -> None:
    """A catalog table at ``path`` whose files are bucketed by the key: joins on it do not shuffle its rows.

    ``gather`` shuffles the rows once, so that each bucket is about one file; pass
    False for rows that come from tables of the same buckets.  All rows of one key
    are in one bucket, which one task reads, as a stream.  Take at least
    ``spark.sql.shuffle.partitions`` buckets: with fewer, Spark shuffles the table
    for the sake of parallel tasks.
    """
    key = list(key)
    rows = df.repartition(buckets, *key) if gather else df
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *key).option("path", path).saveAsTable(table)


def _complete(df: DataFrame, key: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def upsert_bucketed(spark: SparkSession, table: str, changes: DataFrame, key: Iterable[str], sort_key: str,
                    out_table: str, buckets: int, out_path: str) -> DataFrame:
    """``upsert_rows`` on a table of ``write_bucketed``, written as another one of the same buckets.

    Only the changes are shuffled, whatever their size: the base's buckets are
    joined where they lie, and its untouched rows are written as they come.
    Null-safe joins cannot use buckets, so rows with a null in the key, of base
    and changes, are merged by themselves.
    """
    key = list(key)
    base, changes = spark.table(table), write_once(changes, "upsert-changes")
    whole = _complete(base, key)
    touched = changes.where(whole).select(*key).distinct()
    known = base.where(whole)
    hit = known.join(touched, key, "left_semi").select(*base.columns)
    rows = (known.join(touched, key, "left_anti").select(*base.columns)
            .unionByName(_latest(hit, changes.where(whole), key, sort_key))
            .unionByName(upsert_rows(base.where(~whole), changes.where(~whole), key, sort_key)))
    write_bucketed(rows, out_table, key, buckets, out_path, gather=False)
    return spark.table(out_table)


def delete_bucketed(spark: SparkSession, table: str, keys: DataFrame, key: Iterable[str], out_table: str, buckets: int,
                    out_path: str) -> DataFrame:
    """``delete_rows`` on a table of ``write_bucketed``, written as another one; only the keys are shuffled."""
    key = list(key)
    base, keys = spark.table(table), write_once(keys.select(*key), "delete-keys")
    whole = _complete(base, key)
    rows = (base.where(whole).join(keys.where(whole).distinct(), key, "left_anti").select(*base.columns)
            .unionByName(delete_rows(base.where(~whole), keys.where(~whole), key)))
    write_bucketed(rows, out_table, key, buckets, out_path, gather=False)
    return spark.table(out_table)


def write_features(df: DataFrame, path: str) -> None:
    """Write a feature table (as many files as the data needs; no single-file funnel)."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
