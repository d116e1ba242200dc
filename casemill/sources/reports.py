"""Saved classifier reports as tables: one folder of text files in, one row per class or per file out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The layout of a report.
CLASS_ROW = r"^\s*(\S.*?)\s+(\d+\.\d+)\s+(\d+\.\d+)\s+(\d+\.\d+)\s+(\d+)\s*$"
SUMMARY_ROWS = ("accuracy", "macro avg", "weighted avg")
HEADLINES = {
    "macro_f1": "Macro F1",
    "weighted_f1": "Weighted F1",
    "macro_precision": "Macro Precision",
    "macro_recall": "Macro Recall",
}
TOP_K_LINE = r"(?m)^\s*Top-(\d+) Accuracy:\s+([\d.]+)"
PAIR_LINE = r"True='(.+?)'\s+->\s+Predicted='(.+?)'\s+\(x(\d+)\)[^\n]*(?:\n([^\n]*))?"


def class_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per-class precision, recall, F1 and support of every report under ``path``."""
    return parse_class_rows(spark.read.text(path).withColumn("file", F.input_file_name()))


def parse_class_rows(lines: DataFrame) -> DataFrame:
    """The same from a table ``(file, value)`` of report lines."""
    line = F.col("value")
    return (
        lines.filter(line.rlike(CLASS_ROW))
        .select(
            "file",
            F.regexp_extract(line, CLASS_ROW, 1).alias("label"),
            F.regexp_extract(line, CLASS_ROW, 2).cast("double").alias("precision"),
            F.regexp_extract(line, CLASS_ROW, 3).cast("double").alias("recall"),
            F.regexp_extract(line, CLASS_ROW, 4).cast("double").alias("f1_score"),
            F.regexp_extract(line, CLASS_ROW, 5).cast("long").alias("support"),
        )
        .filter(~F.lower("label").isin(*SUMMARY_ROWS))
    )


def _reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("file"), F.regexp_replace("value", "\r\n?", "\n").alias("text")
    )


def _headline(name: str, is_new):
    value = F.regexp_extract("text", rf"(?m)^\s*{name}:\s*([\d.]+)", 1)
    return F.when(is_new & (value != ""), value.try_cast("double"))


def headlines(spark: SparkSession, path: str) -> DataFrame:
    """Format, accuracy and averaged scores of every report; scores a format lacks are null."""
    return parse_headlines(_reports(spark, path))


def parse_headlines(reports: DataFrame) -> DataFrame:
    """The same from a table ``(file, text)`` of whole reports."""
    is_new = F.col("text").rlike(r"(?m)^Macro F1:")
    legacy = F.regexp_extract("text", r"(?m)^Best Accuracy:\s*([\d.]+)", 1)
    top_k = F.transform(
        F.regexp_extract_all("text", F.lit(TOP_K_LINE), F.lit(0)),
        lambda s: F.struct(
            F.regexp_extract(s, TOP_K_LINE, 1).cast("int").alias("k"),
            F.regexp_extract(s, TOP_K_LINE, 2).cast("double").alias("accuracy"),
        ),
    )
    return reports.select(
        "file",
        F.when(is_new, "new").otherwise("legacy").alias("format"),
        F.coalesce(_headline("Accuracy", is_new), F.when(~is_new & (legacy != ""), legacy.try_cast("double")))
        .alias("accuracy"),
        *[_headline(label, is_new).alias(name) for name, label in HEADLINES.items()],
        F.when(is_new, F.map_from_entries(top_k)).alias("top_k_accuracy"),
    )


def confused_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Confused class pairs listed in reports of the new format, with the line that explains them."""
    pair = F.col("pair")
    return (
        _reports(spark, path)
        .filter(F.col("text").rlike(r"(?m)^Macro F1:"))
        .select("file", F.explode(F.regexp_extract_all("text", F.lit(PAIR_LINE), F.lit(0))).alias("pair"))
        .select(
            "file",
            F.regexp_extract(pair, PAIR_LINE, 1).alias("true_label"),
            F.regexp_extract(pair, PAIR_LINE, 2).alias("predicted_label"),
            F.regexp_extract(pair, PAIR_LINE, 3).cast("long").alias("count"),
            F.trim(F.regexp_extract(pair, PAIR_LINE, 4)).alias("explanation"),
        )
    )
