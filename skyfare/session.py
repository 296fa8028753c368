"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared file system such as HDFS or an object store).  Only when that setting
is absent -- local tests, the bench -- do we create a private folder and
register it as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no broadcast decided from file-size estimates; broadcasts are either behind an
    # explicit bounded count (operators/sizing.py) or chosen by AQE from measured sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    # HotSpot does not JIT-compile a method over 8000 bytes of bytecode.  The merge's
    # last stage fuses three joins, the fills, the key hash and a 30-column null check
    # into one ~19.5 kB method, which then runs interpreted (measured 3x slower);
    # above this limit Spark keeps per-operator generated code, which does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "skyfare", extra: dict | None = None) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE on, no UI)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # settings that may be changed on a running session
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SCRATCH_LOCK = threading.Lock()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session; sets a private one only
    when it is unset (tests, local runs).
    """
    sc = spark.sparkContext
    with _SCRATCH_LOCK:          # write_once() may run from several driver threads
        current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="skyfare-ckpt-")
        # register it for Dataset.checkpoint() if the context has none yet
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def write_once(df, name: str):
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    The rows behind it are computed once, later passes prune columns and push
    filters into the files, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``write_once`` made and ``discard_written`` has not deleted yet.
_WRITTEN: list[str] = []


def discard_written(spark: SparkSession) -> int:
    """Delete the tables that ``write_once`` has made; call it when all results have been read.

    DataFrames that were returned before may still read them, so nothing is
    deleted on its own.  Returns the number of tables.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    done = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done


_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    Functions given to mapInPandas and its like are pickled by module name, so
    workers need the package whatever their working directory is.
    """
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if getattr(sc, "_skyfare_shipped", False):
            return
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="skyfare-pkg-"), "skyfare_package.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in sorted(os.walk(package)):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.join("skyfare", os.path.relpath(full, package)))
        sc.addPyFile(archive)
        sc._skyfare_shipped = True


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
