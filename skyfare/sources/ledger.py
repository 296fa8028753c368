"""Ingest of new files only: what was ingested stands in a ledger, kept with the table's version.

A run compares the files it finds with the ledger by name, size and modification
time and loads those that are not in it, so a run that is repeated, or repeated
after it died, adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.session import write_once
from skyfare.sources import listed
from skyfare.sources.lake import delete_rows

SOURCE = "source_file"


def find_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, source, size, modified) of the files below ``root`` whose name matches; contents are not read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(root))
    return found.select("path", F.col("_metadata.file_path").alias("source"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def source_of_row():
    """The name by which the ledger knows a row's file."""
    return F.col("_metadata.file_path").alias(SOURCE)


def ingest_new(spark: SparkSession, table: str, files: DataFrame, load: Callable[[list[str]], DataFrame],
               on_change: str = "refuse") -> int:
    """Load the files that the ledger does not have into the listed table; returns how many.

    ``files``: as ``find_files`` gives them.  ``load(paths)``: the rows of these
    files, each with its ``source_file`` (``source_of_row``).  A file that is
    in the ledger with another size or time is changed: ``refuse`` raises and
    loads nothing, ``replace`` puts its new rows in place of the old ones,
    rewriting only the table's files that hold them.  Files that are gone keep
    their rows.  The same name twice in ``files`` counts once, the latest.
    """
    if on_change not in ("refuse", "replace"):
        raise ValueError(f"on_change: {on_change}")
    latest = F.max_by(F.struct("path", "size", "modified"), F.struct("modified", "size", "path"))
    files = files.groupBy("source").agg(latest.alias("f")).select("source", "f.*")
    done = listed.ledger(spark, table)
    fresh = write_once(files.join(done, ["source", "size", "modified"], "left_anti"), "new-files")
    changed = fresh.join(done, "source", "left_semi").select("source")
    paths = [r.path for r in fresh.select("path").collect()]  # file names, as Spark's own listing holds them
    if not paths:
        return 0
    first = changed.limit(3).collect()
    if first and on_change == "refuse":
        raise ValueError(f"ingested before with another size or time: {', '.join(r.source for r in first)}")
    kept = listed.listed_files(spark, table) if listed.versions(spark, table) else None
    if first:
        old = write_once(changed.select(F.col("source").alias(SOURCE)), "changed-files")
        hit = write_once(listed.touched_files(spark, table, old, [SOURCE]), "touched-files")
        kept, _ = listed.replaced(spark, table, hit, lambda rows: delete_rows(rows, old, [SOURCE]))
    new = listed.write_batch(spark, table, load(paths))
    sources = done.join(fresh, "source", "left_anti").unionByName(fresh.select("source", "size", "modified"))
    listed.commit(spark, table, new if kept is None else kept.unionByName(new), sources)
    return len(paths)
