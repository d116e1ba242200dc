"""Session settings, and staging of shared intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans depend on. All of them can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method of more than 8,000 bytes. A stage whose one method would be longer runs as separate
    # projections, whose code Spark splits.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "casemill", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def spread(scan: DataFrame) -> DataFrame:
    """Give a table of fewer files than cores to all cores, before costly work per row. Only for a plain scan; the
    files are listed, nothing is run."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if len(scan.inputFiles()) >= cores else scan.repartition(cores)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one, removed at exit, only where driver and tasks are one
    process."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="casemill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Used where several results start from one intermediate table: the lineage is cut, a lost
    executor costs no recomputation, and the readers get column pruning, push-down and true sizes.
    """
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/casemill/{name}-{uuid.uuid4().hex}"
    for kept in _scopes:
        kept.append(path)
    df.write.options(**options).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


def unstage(df: DataFrame) -> None:
    """Remove a table that ``stage`` stored; nothing may read it any more."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def staged_tables_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``stage`` stores inside the block. Use it where the results are written before it ends."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            _delete(spark, path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query go when it ends, and not when the driver happens to collect its garbage. Use
    it where every query writes what later ones read."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
