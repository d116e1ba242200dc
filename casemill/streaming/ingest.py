"""Incremental ingest of raw CSV files as they arrive.

Processing is stateless, so the batch projection runs on every step unchanged. Each step writes its own
partition and overwrites it when it is repeated after a failure. Ids may come back in later files; a reader of
the stored table keeps the first row of each (the stored rows carry step, file and position for that).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from casemill.operators.ingest import dedupe_first, preprocess
from casemill.sources.complaints import ROW_ORDER, read_raw_csv, save_table
from casemill.streaming.cubes import add_step

FILE, STEP = "_file", "step"


def raw_stream(spark: SparkSession, folder: str, files_per_step: int = 64) -> DataFrame:
    """The lines of new CSV files of ``folder``. A step only takes the file names from it and reads the files by
    their own headers."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_step).text(folder)
    return lines.select(F.col("_metadata.file_path").alias(FILE))


def ingest_available(
    spark: SparkSession, source: str, target: str, checkpoint: str, multi_line: bool = True,
    files_per_step: int = 64, cube: str | None = None,
) -> StreamingQuery:
    """Process what has arrived since the last call, add it to ``target``, and stop. With ``cube`` the states of the new
    rows are stored there too (``streaming.cubes``)."""

    def write(step: DataFrame, number: int) -> None:
        # at most files_per_step names
        files = sorted(unquote(r[FILE]) if "%" in r[FILE] else r[FILE] for r in step.distinct().collect())
        if files:
            path = f"{target.rstrip('/')}/{STEP}={number}"
            save_table(preprocess(read_raw_csv(step.sparkSession, files, multi_line)), path)
            if cube:
                add_step(step.sparkSession.read.parquet(path), cube, number, [F.col(ROW_ORDER)])

    stream = raw_stream(spark, source, files_per_step)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()


def stored_cases(spark: SparkSession, target: str) -> DataFrame:
    """The stored table with the first row of every id."""
    order = [F.col(STEP), F.col(ROW_ORDER)]
    return dedupe_first(spark.read.parquet(target), ["Complaint ID"], order).drop(ROW_ORDER, STEP)
