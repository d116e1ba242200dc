"""A star schema (order lines and their dimensions) seen as one complaint table.

Only the dimensions that the asked columns need are joined. No join carries a broadcast hint: Catalyst
broadcasts a side whose size it knows to be small, and beyond that adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.functions import dates, text
from casemill.operators.ingest import consumer_group
from casemill.session import spread
from casemill.sources.complaints import NARRATIVE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _received():
    return F.col("o_orderdate").cast("timestamp")


def _sent():
    return F.col("l_shipdate").cast("timestamp")


def _part(name: str):
    return lambda: dates.calendar_parts(_received())[name]


def _or_zero(name: str):
    return lambda: F.coalesce(F.col(name), F.lit(0))


# Column of the view: the tables besides the order lines that it needs, and its expression.
COLUMNS = {
    "Complaint ID": ((), lambda: F.col("l_orderkey") * 10 + F.col("l_linenumber")),
    "Date received": (("orders",), _received),
    "Date sent to company": ((), _sent),
    "Timely response?": (
        (), lambda: F.when(F.col("l_linestatus") == "O", "Yes").when(F.col("l_linestatus") == "F", "No")
    ),
    "Company response to consumer": ((), lambda: F.col("l_returnflag")),
    "Submitted via": (("orders",), lambda: F.col("o_orderpriority")),
    "Resolution_Delay": (("orders",), lambda: dates.whole_days_between(_received(), _sent())),
    **{part: (("orders",), _part(part)) for part in ("Year", "Month", "Quarter", "Day", "Day_Name")},
    "Product": (("part",), lambda: F.col("p_type")),
    "Issue": (("part",), lambda: F.col("p_brand")),
    "Sub-issue": (("part",), lambda: F.col("p_name")),
    "Company": (("supplier",), lambda: F.col("s_name")),
    "State": (("supplier", "nation"), lambda: F.col("n_name")),
    "Tags": (("orders", "customer"), lambda: F.col("c_mktsegment")),
    "Consumer_Group": (("orders", "customer"), lambda: consumer_group(F.col("c_mktsegment"))),
    NARRATIVE: (("documents",), lambda: F.col("text")),
    "Has_Narrative": (("documents",), _or_zero("has_text")),
    "Narrative_Length": (("documents",), _or_zero("n_chars_text")),
    "Narrative_Word_Count": (("documents",), _or_zero("n_words")),
}
COSTLY = {"Narrative_Word_Count"}


PART_BYTES = 256 << 20  # of order lines, as stored, that are joined at a time


def part_count(spark: SparkSession, folder: str) -> int:
    """Parts of the view that keep what a join has to move bounded."""
    size = int(table(spark, folder, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // PART_BYTES))


def cases(
    spark: SparkSession, folder: str, columns: Iterable[str], spread_rows: bool = False, part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """The complaint view with the given columns. ``spread_rows``: the order lines go to all cores before costly work per row.
    ``part``: number and count of parts, to which orders are dealt by their key; an id is in one of them.

    Tables that hang on a table are joined to it first, so that an order line travels once for orders, parts and suppliers
    each, and what belongs to its order comes in the first journey."""
    wanted = {name: COLUMNS[name] for name in columns}
    needed = {t for tables, _ in wanted.values() for t in tables}

    def dealt(df: DataFrame, key: str) -> DataFrame:
        number, count = part
        return df if count == 1 else df.where(F.pmod(F.hash(F.col(key).cast("bigint")), F.lit(count)) == number)

    rows = dealt(table(spark, folder, "lineitem"), "l_orderkey")
    if spread_rows:
        rows = spread(rows)
    if "orders" in needed:
        orders = dealt(table(spark, folder, "orders"), "o_orderkey")
        if "customer" in needed:
            orders = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "documents" in needed:
        # The features are taken before the join, so that three integers travel and not the text.
        documents = dealt(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
        features = (spread(documents) if COSTLY & set(wanted) else documents).select(
            "doc_id", "text", F.lit(1).alias("has_text"), text.char_count(F.col("text")).alias("n_chars_text"),
            text.word_count(F.col("text")).alias("n_words"),
        )
        rows = rows.join(features, F.col("l_orderkey") == F.col("doc_id"), "left")
    if "part" in needed:
        rows = rows.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in needed:
        suppliers = table(spark, folder, "supplier")
        if "nation" in needed:
            suppliers = suppliers.join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(*[expr().alias(name) for name, (_, expr) in wanted.items()])


def document_narratives(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as narratives: id, text, Product (language) and Issue (source)."""
    return spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source")).select(
        "doc_id", F.col("text").alias(NARRATIVE), F.col("lang").alias("Product"), F.col("source").alias("Issue")
    )
