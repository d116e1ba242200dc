"""The complaint schema, its raw CSV scan and its Parquet tables."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The 16 required raw columns.
RAW_COLUMNS = (
    "Date received", "Product", "Sub-product", "Issue", "Sub-issue", "Consumer complaint narrative",
    "Company public response", "Company", "State", "ZIP code", "Tags", "Submitted via",
    "Date sent to company", "Company response to consumer", "Timely response?", "Complaint ID",
)
NARRATIVE = "Consumer complaint narrative"
ROW_ORDER = "_row_order"
_REJECT = "_malformed"
HEADERS_AT_ONCE, HEADER_LINES = 32, 100


def require_columns(df: DataFrame, names: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Optional guard; runs a job that stops at the first row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def raw_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, _REJECT)])


def _field_count(record: Column) -> Column:
    unquoted = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.regexp_count(unquoted, F.lit(",")) + 1


def csv_options(reader, multi_line: bool):
    return reader.options(
        header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=_REJECT,
    )


def drop_overlong(df: DataFrame) -> DataFrame:
    """Short rows stay (missing fields are null); rows with too many fields go."""
    width = len([c for c in df.columns if c not in (_REJECT, ROW_ORDER)])
    overlong = F.col(_REJECT).isNotNull() & (_field_count(F.col(_REJECT)) > width)
    return df.filter(~F.coalesce(overlong, F.lit(False))).drop(_REJECT)


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """All columns as text, plus ``_row_order`` (file, position) for keep-first de-duplication. Columns are matched by
    name: files may have other column orders and further columns; a file without a required one is an error.

    A multi-line CSV file cannot be split, so the input should come as many files; set
    ``multi_line=False`` for splittable reads when no field holds a line break.
    """
    parts = [
        _read_as(spark, files, names, multi_line) for names, files in _files_by_header(spark, path).items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _first_record(spark: SparkSession, path: str) -> str | None:
    """The first record of a file, also if one of its names holds a line break; null for an empty file."""
    hadoop, java = spark._jvm.org.apache.hadoop, spark._jvm.java.io
    conf, at = spark._jsc.hadoopConfiguration(), hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        reader = java.BufferedReader(java.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        record = reader.readLine()
        for _ in range(HEADER_LINES):
            if record is None or record.count('"') % 2 == 0:
                return record
            record = f"{record}\n{reader.readLine() or ''}"
        raise ValueError(f"the header of {path} does not end")
    finally:
        stream.close()


def _files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. The files are listed anyway to be read; of each only the first record is looked at, many
    files at a time, so the raw data are read once."""
    files = sorted(unquote(f) if "%" in f else f for f in spark.read.text(path).inputFiles())
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, record in zip(files, pool.map(lambda f: _first_record(spark, f), files)):
            if record is not None:
                names = next(csv.reader(io.StringIO(record.removeprefix("\ufeff"), newline="")), [])
                found.setdefault(tuple(names), []).append(file)
    if not found:
        raise ValueError(f"no rows under {path}")
    return found


def _read_as(spark: SparkSession, files: list[str], names: tuple[str, ...], multi_line: bool) -> DataFrame:
    """Files with one header; each of them must have the required columns, in any order."""
    missing = [n for n in RAW_COLUMNS if n not in names]
    if missing:
        raise ValueError(f"Missing required columns: {missing} in {files[0]}")
    order = F.struct(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("position")
    )
    reader = csv_options(spark.read.schema(raw_schema(names)), multi_line)
    return drop_overlong(reader.csv(files).withColumn(ROW_ORDER, order))


def first_rows(df: DataFrame, n: int = 500_000) -> DataFrame:
    """The first ``n`` rows, for a look at a raw file."""
    return df.limit(n)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def narratives(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Narrative, Product and Issue, all present; ``keep`` adds columns such as the date or the id."""
    columns = [NARRATIVE, "Product", "Issue"]
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return df.filter(present).select(*columns, *keep)


def save_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def summary_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def save_summary(df: DataFrame, folder: str, name: str) -> None:
    save_table(df, summary_path(folder, name))
