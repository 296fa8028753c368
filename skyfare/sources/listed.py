"""Tables as lists of files: an upsert, delete or ingest writes only the files it changes.

``path/data/<batch>/...`` holds Parquet files, which are never changed.  Each
version is a folder ``path/lists/<number>`` with the names of its files and, for
ingested tables, a folder ``path/sources/<number>`` with the ledger of what was
ingested.  The list is written last, and only a list with its ``_SUCCESS`` file
counts, so a job that dies leaves the version before it readable and its own
files unlisted.  One writer at a time; a reader keeps the version it began with.

The driver holds the file names of a version, as Spark's own file listing does,
and no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyfare.operators.sizing import checked_count
from skyfare.session import write_once
from skyfare.sources.lake import _same_key, delete_rows, upsert_rows

LEDGER = "source STRING, size BIGINT, modified TIMESTAMP"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the complete versions, ascending."""
    fs, at = _folder(spark, f"{path}/lists")
    if not fs.exists(at):
        return []
    done = [e.getPath() for e in fs.listStatus(at) if e.isDirectory()]
    marked = [p for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName()) for p in marked)


def _version(spark: SparkSession, path: str, version: int | None) -> int:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no complete version {'' if version is None else version} of {path}")
    return known[-1] if version is None else version


def listed_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(file): names below ``path/data`` of the files of a version (default: the newest)."""
    return spark.read.schema("file STRING").parquet(f"{path}/lists/{_version(spark, path, version):010d}")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(source, size, modified) of what the newest version has ingested; empty for a table without versions."""
    known = versions(spark, path)
    folder = f"{path}/sources/{known[-1]:010d}" if known else None
    if folder is None or not (at := _folder(spark, folder))[0].exists(at[1]):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def _schema(spark: SparkSession, path: str, version: int) -> StructType:
    return spark.read.parquet(*_names(spark, path, listed_files(spark, path, version).limit(1))).schema


def _names(spark: SparkSession, path: str, files: DataFrame) -> list[str]:
    return [f"{path}/data/{r.file}" for r in files.collect()]


def _file_name():
    return F.regexp_extract("_metadata.file_path", r"/data/([^/]+/[^/]+)$", 1)


def read_listed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (default: the newest)."""
    version = _version(spark, path, version)
    names = _names(spark, path, listed_files(spark, path, version))
    return spark.read.schema(_schema(spark, path, version)).parquet(*names)


def write_batch(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Write rows as a new, unlisted batch of files, one for each partition: (file) names."""
    batch = uuid.uuid4().hex
    rows.write.parquet(f"{path}/data/{batch}")
    names = [f.rsplit("/data/", 1)[1] for f in spark.read.schema(rows.schema).parquet(f"{path}/data/{batch}").inputFiles()]
    return spark.createDataFrame([(n,) for n in names], "file STRING")


def commit(spark: SparkSession, path: str, files: DataFrame, sources: DataFrame | None = None) -> int:
    """Make ``files`` the next version; ``sources`` is its ledger (None: the ledger stays)."""
    known = versions(spark, path)
    number = known[-1] + 1 if known else 0
    sources = ledger(spark, path) if sources is None else sources
    sources.write.mode("overwrite").parquet(f"{path}/sources/{number:010d}")  # over what a dead job left
    files.write.mode("overwrite").parquet(f"{path}/lists/{number:010d}")
    return number


def create_listed(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Version 0 of a new table.  Rows sorted or ranged by a key put a change of few keys in few files."""
    if versions(spark, path):
        raise FileExistsError(path)
    return commit(spark, path, write_batch(spark, path, rows))


def touched_files(spark: SparkSession, path: str, keys: DataFrame, key: Iterable[str]) -> DataFrame:
    """(file): files of the newest version that hold a row of ``keys``; only the key columns are read."""
    key = list(key)
    wanted = keys.select(*[F.col(c).alias(f"_k_{c}") for c in key])
    small = checked_count(wanted) is not None
    wanted = wanted.distinct()
    rows = read_listed(spark, path).select(*key, _file_name().alias("file"))
    return rows.join(F.broadcast(wanted) if small else wanted, _same_key(key), "left_semi").select("file").distinct()


def replaced(spark: SparkSession, path: str, hit: DataFrame, rows_of) -> tuple[DataFrame, int]:
    """(list in which the files of ``hit`` are replaced by ``rows_of`` their rows, files replaced).

    The new files are of advisory size, whatever number of tasks made the rows.
    """
    version = _version(spark, path, None)
    files, names = listed_files(spark, path, version), _names(spark, path, hit)
    schema = _schema(spark, path, version)
    old = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    kept = files.join(hit, "file", "left_anti")
    return kept.unionByName(write_batch(spark, path, rows_of(old).hint("rebalance"))), len(names)


def upsert_listed(spark: SparkSession, path: str, changes: DataFrame, key: Iterable[str], sort_key: str) -> int:
    """``lake.upsert_rows`` on the files that hold touched keys; returns the new version.

    Files without a touched key are carried over by name.
    """
    key = list(key)
    changes = write_once(changes, "upsert-changes")
    hit = write_once(touched_files(spark, path, changes, key), "touched-files")
    files, _ = replaced(spark, path, hit, lambda old: upsert_rows(old, changes, key, sort_key))
    return commit(spark, path, files)


def delete_listed(spark: SparkSession, path: str, keys: DataFrame, key: Iterable[str]) -> int:
    """``lake.delete_rows`` on the files that hold these keys; returns the version (the same if none does)."""
    key = list(key)
    keys = write_once(keys.select(*key), "delete-keys")
    hit = write_once(touched_files(spark, path, keys, key), "touched-files")
    files, n = replaced(spark, path, hit, lambda old: delete_rows(old, keys, key))
    return commit(spark, path, files) if n else _version(spark, path, None)
