"""Session defaults, shared working folders and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_made: dict[str, SparkSession] = {}


def build_session(app_name: str = "lexloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts: the cluster's `spark.checkpoint.dir`.

    Only a local session, whose executors see the driver's disk, may fall back
    to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="lexloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed by `clean_up` or when Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_last_clean_up)
    _made[path] = spark
    return path


def clean_up() -> None:
    """Remove every intermediate file of this process whose session still runs.

    Call it when a job's results are written; tables that plans still read go with it.
    """
    for path, spark in list(_made.items()):
        del _made[path]
        if spark.sparkContext._jsc is not None:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _last_clean_up() -> None:
    """As Python ends the JVM may be gone already; then nothing can be removed any more."""
    with contextlib.suppress(Exception):
        clean_up()


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once into Parquet under the shared folder, for plans that read it repeatedly.

    Later plans read only the columns they use; lost executors lose nothing.
    """
    path = work_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
