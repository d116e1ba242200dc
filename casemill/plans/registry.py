"""Every operator as a named query over a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions import dates, labels, text
from casemill.functions.arrays import let
from casemill.operators import (
    classify, counts, drivers, evaluate, forecast, growth, ingest, predictions, profile, recommend, risk, sampling,
    similar, tables, taxonomy, topics, words,
)
from casemill.operators.facts import CubeFacts
from casemill.params import Params
from casemill.plans.summaries import Analysis, run_all, staged_analysis
from casemill.session import checkpoint_folder, configure, shuffles_removed, spread, stage, staged_tables_removed
from casemill.sources import reports, star
from casemill.sources.complaints import NARRATIVE, RAW_COLUMNS, ROW_ORDER, narratives, read_raw_csv, save_summary, summary_path
from casemill.sources.star import cases, document_narratives, table
from casemill.streaming import cubes

# The floors and the growth threshold that suit the size of the tables.
P = Params(growth_floor=100, emerging_growth=0.005)
TIMELY, RESPONSE = "Timely response?", "Company response to consumer"
RISK_COLUMNS = ("Company", TIMELY, "Resolution_Delay")
ANALYSIS_COLUMNS = (*RISK_COLUMNS, "Product", "Issue", "Sub-issue", "Year", "Month")
KPI_COLUMNS = (*RISK_COLUMNS, "Product", "State", "Issue", "Submitted via", "Year", "Has_Narrative")
FEATURE_COLUMNS = ("Year", "Product", "Has_Narrative", "Narrative_Word_Count")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(fn(configure(spark), folder))

        QUERIES[name] = run
        return fn

    return add


def over_cases(name: str, columns, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: fn(cases(spark, folder, columns)))


def value_count_query(name: str, key: str, out: str | None = None, k: int | None = None) -> None:
    over_cases(name, [key], lambda df: counts.value_counts(df, key, out, k=k))


# Key figures, counts, shares, trends ---------------------------------------------------------------

over_cases("kpis", KPI_COLUMNS, counts.kpis)
over_cases("mode_value", ["Sub-issue"], lambda df: counts.mode_value(df, "Sub-issue"))
over_cases("yearly_trend", ["Year"], counts.yearly_trend)
value_count_query("timely_response", TIMELY, "Timely Response")
value_count_query("submitted_via", "Submitted via", "Channel")
value_count_query("consumer_group", "Consumer_Group", "Consumer Group")
value_count_query("resolution_summary", RESPONSE, "Resolution Type")
value_count_query("narrative_availability", "Has_Narrative", "Has Narrative")
value_count_query("state_map", "State")
value_count_query("top_products", "Product", k=P.top_products)
value_count_query("top_issues", "Issue", k=P.top_issues)
value_count_query("top_sub_issues", "Sub-issue", "Sub Issue", k=P.top_issues)
value_count_query("top_companies", "Company", k=P.top_companies)
value_count_query("top_states", "State", k=P.top_states)
over_cases("product_share", ["Product"], lambda df: counts.shares(df, "Product", k=P.share_rows))
over_cases("company_share", ["Company"], lambda df: counts.shares(df, "Company", k=P.share_rows))
over_cases("value_share", ["Issue"], lambda df: counts.shares(df, "Issue", digits=2))
over_cases("year_product_trend", ["Year", "Product"], lambda df: counts.trend_by(df, "Product"))
over_cases("issue_trend", ["Year", "Issue"], lambda df: counts.trend_by(df, "Issue", P.trend_keys))
over_cases("top_five_product_trend", ["Year", "Product"], lambda df: counts.trend_by(df, "Product", 5))
over_cases("issue_product_heatmap", ["Issue", "Product"], lambda df: counts.cross_counts(
    df, ["Issue", "Product"], top={"Issue": P.trend_keys, "Product": P.trend_keys}))
over_cases("heatmap_pivot", ["Issue", "Product"], lambda df: counts.pivot_counts(
    df, "Issue", "Product", top={"Issue": P.trend_keys, "Product": P.trend_keys}))
over_cases("company_timely_response", ["Company", TIMELY], lambda df: counts.cross_counts(
    df, ["Company", TIMELY], top={"Company": P.trend_keys}))
over_cases("company_resolution", ["Company", RESPONSE], lambda df: counts.cross_counts(
    df, ["Company", RESPONSE], top={"Company": P.trend_keys}))
over_cases("regex_company_summary", ["Company", TIMELY], lambda df: counts.name_match_summary(
    df, "supplier#0+1|SUPPLIER#0+2"))
over_cases("resolution_by_year", ["Year", RESPONSE], lambda df: counts.cross_counts(df, ["Year", RESPONSE]))
over_cases("crosstab", ["Consumer_Group", "Product"], lambda df: counts.cross_counts(df, ["Consumer_Group", "Product"]))
over_cases("year_pivot", ["Year", "Product"], lambda df: counts.pivot_counts(df, "Product", "Year"))
over_cases("dominant_partner", ["State", "Product"], lambda df: counts.dominant_partner(
    df, "State", "Product", "Top_Product", "Complaint_Count"))
over_cases("dominant_company", ["Issue", "Company"], lambda df: counts.dominant_partner(
    df, "Issue", "Company", "Top_Company", "Count"))
for part in ("Month", "Quarter", "Day_Name"):
    value_count_query(f"count_by_{part.lower()}", part)

# Delays and narratives -----------------------------------------------------------------------------

over_cases("delay_distribution", ["Resolution_Delay"], counts.delay_distribution)
over_cases("delay_histogram", ["Resolution_Delay"], lambda df: counts.histogram(
    counts.delay_distribution(df), "Resolution_Delay"))
over_cases("words_histogram", ["Narrative_Word_Count"], lambda df: counts.histogram(
    counts.narrative_word_counts(df), "Narrative_Word_Count"))
over_cases("narrative_word_count", ["Narrative_Word_Count"], counts.narrative_word_counts)
over_cases("narrative_length_trend", FEATURE_COLUMNS, counts.narrative_length_trend)
over_cases("narrative_complexity", FEATURE_COLUMNS, counts.narrative_complexity)
over_cases("narrative_product_length", FEATURE_COLUMNS, lambda df: counts.narrative_length_by(df, "Product", 15))
over_cases("narrative_issue_length", ("Issue", "Has_Narrative", "Narrative_Word_Count"),
           lambda df: counts.narrative_length_by(df, "Issue", 15))
# Without word counts the text length takes their place.
over_cases("column_fallback", ("Product", "Has_Narrative", "Narrative_Length"),
           lambda df: counts.narrative_length_by(df, "Product"))
over_cases("narrative_product_availability", FEATURE_COLUMNS, lambda df: counts.narrative_availability_by(
    df, "Product", 15))


@query("top_narrative_words")
def _(spark, folder):
    return words.top_words(document_narratives(spark, folder), NARRATIVE)


for size, phrase in ((1, "word"), (2, "bigram"), (3, "trigram")):
    query(f"top_{phrase}s")(
        lambda spark, folder, n=size: words.top_ngrams(document_narratives(spark, folder), NARRATIVE, n)
    )

# Risk, drivers, growth -----------------------------------------------------------------------------

over_cases("company_risk_score", RISK_COLUMNS, risk.company_risk)
over_cases("top_risk_companies", RISK_COLUMNS, lambda df: risk.company_risk(df).limit(20))
over_cases("risk_level_counts", RISK_COLUMNS, lambda df: risk.risk_level_counts(risk.company_risk(df)))
over_cases("risk_breakdown_unpivot", RISK_COLUMNS, lambda df: risk.risk_factors(risk.company_risk(df)))
over_cases("driver_analysis", drivers.KEYS, drivers.drivers_of_top_products)
over_cases("top_complaint_drivers", drivers.KEYS, lambda df: drivers.top_drivers(drivers.all_drivers(df)))
over_cases("product_driver_summary", drivers.KEYS, lambda df: drivers.top_drivers_per_product(drivers.all_drivers(df)))
over_cases("driver_rollup", drivers.KEYS, lambda df: counts.rollup_counts(df, drivers.KEYS))
over_cases("product_growth", ["Year", "Product"], lambda df: growth.yoy_growth(df, "Product", P))
over_cases("issue_growth", ["Year", "Issue"], lambda df: growth.yoy_growth(df, "Issue", P))


@query("emerging_keys")
def _(spark, folder):
    """Routes (company, channel and issue): a triple is new when it had no row the year before."""
    df = cases(spark, folder, ["Year", "Company", "Submitted via", "Issue"])
    route = F.concat_ws(" / ", "Company", "Submitted via", "Issue")
    found = growth.yoy_growth(df.withColumn("Route", route), "Route", Params(growth_floor=1))
    return growth.emerging(found, 1)


over_cases("monthly_trend", ["Year", "Month"], growth.monthly_trend)
over_cases("last_n_months", ["Year", "Month"], lambda df: counts.last_rows(
    growth.monthly_trend(df), ["Year", "Month"], 60))

# Forecast and recommendations ----------------------------------------------------------------------

over_cases("complaint_forecast", ["Year", "Month"], lambda df: forecast.forecast(growth.monthly_trend(df)))
over_cases("forecast_validation", ["Year", "Month"], lambda df: forecast.validation(growth.monthly_trend(df)))
over_cases("forecast_summary", ["Year", "Month"], lambda df: forecast.forecast_summary(growth.monthly_trend(df)))


def _monthly_by(df: DataFrame, key: str) -> DataFrame:
    rows = counts.cross_counts(df, [key, "Year", "Month"], "Complaints")
    return rows


over_cases("forecast_by_company", ["Company", "Year", "Month"], lambda df: forecast.forecast(
    _monthly_by(df, "Company"), ["Company"], strict=False))
over_cases("forecast_summary_by_product", ["Product", "Year", "Month"], lambda df: forecast.forecast_summary(
    _monthly_by(df, "Product"), ["Product"], strict=False))


def _analysis(df: DataFrame) -> Analysis:
    return staged_analysis(df, P)


over_cases("recommendations", ANALYSIS_COLUMNS, lambda df: recommend.recommendations(_analysis(df).recommendation_rows))
over_cases("high_priority", ANALYSIS_COLUMNS, lambda df: recommend.by_priority(
    _analysis(df).recommendation_rows.select(*recommend.COLUMNS), ["High"]))
over_cases("action_plan", ANALYSIS_COLUMNS, lambda df: recommend.action_plan(_analysis(df).recommendation_rows))
over_cases("recommendation_summary", ANALYSIS_COLUMNS, lambda df: recommend.summary(_analysis(df).recommendation_rows))


@query("executive_rollup")
def _(spark, folder):
    a = _analysis(cases(spark, folder, ANALYSIS_COLUMNS))
    return recommend.executive_rollup(a.risk, a.top_drivers, a.product_growth, a.issue_growth, a.forecast_summary)


SUMMARY_COLUMNS = (*ANALYSIS_COLUMNS, "State", "Submitted via", "Consumer_Group", RESPONSE, "Has_Narrative",
                   "Narrative_Word_Count")


def run_summaries(spark: SparkSession, folder: str, out: str | None = None) -> dict[str, DataFrame]:
    """Every summary table of the star schema: the joined view is stored once and read from there."""
    texts = words.top_words(document_narratives(spark, folder), NARRATIVE)
    if not out:
        view = stage(cases(configure(spark), folder, SUMMARY_COLUMNS), "cases")
        return {**run_all(view, P), "top_narrative_words": texts}
    with staged_tables_removed(spark):
        tables = run_all(stage(cases(configure(spark), folder, SUMMARY_COLUMNS), "cases"), P, out)
        save_summary(texts, out, "top_narrative_words")
    return {**tables, "top_narrative_words": spark.read.parquet(summary_path(out, "top_narrative_words"))}


STEP_YEARS = ((None, 1997), (1998, 1999), (2000, None))
STEP_ORDER = ("Year", *[c for c in SUMMARY_COLUMNS if c != "Year"])


def stepwise_cube(spark: SparkSession, folder: str) -> CubeFacts:
    """All cases in three deliveries by year, the last of which brings the rows of 1995 again. Of the rows of one id the first
    by year and the other columns counts."""
    def add_up() -> CubeFacts:
        year = F.coalesce(F.col("Year"), F.lit(0))
        target = f"{checkpoint_folder(spark).rstrip('/')}/casemill/steps-{uuid.uuid4().hex}"
        with staged_tables_removed(spark), shuffles_removed(spark):
            # the joined view is stored once for all deliveries, part by part
            n = star.part_count(spark, folder)
            parts = [stage(cases(spark, folder, ("Complaint ID", *SUMMARY_COLUMNS), part=(i, n)), "cases") for i in range(n)]
            for k, (since, until) in enumerate(STEP_YEARS):
                due = (year >= (since or 0)) & (year <= (until or 9999))
                due = due | (year == 1995) if until is None else due
                rows = [part.where(due) for part in parts]
                cubes.add_step(rows if n > 1 else rows[0], target, k, [F.col(c) for c in STEP_ORDER])
                if k == 1:
                    cubes.merge_steps(spark, target)
        return cubes.stored_cube(spark, target)

    return _once(spark, folder, "stepwise", add_up)


query("stepwise_kpis")(lambda spark, folder: counts.kpis(stepwise_cube(spark, folder)))
query("stepwise_company_risk")(lambda spark, folder: Analysis(stepwise_cube(spark, folder), P).risk)
query("stepwise_product_growth")(lambda spark, folder: Analysis(stepwise_cube(spark, folder), P).product_growth)
query("stepwise_recommendations")(lambda spark, folder: recommend.recommendations(
    Analysis(stepwise_cube(spark, folder), P).recommendation_rows))


# Cleaning, features, profiles ----------------------------------------------------------------------


def raw_complaints(spark: SparkSession, folder: str) -> DataFrame:
    """The star schema as raw complaint text: padded names, missing markers, mixed and unreadable dates."""
    df = cases(spark, folder, ["Complaint ID", "Date received", "Date sent to company", "Product", "Issue", "Sub-issue",
                               "Company", "State", "Tags", "Submitted via", RESPONSE, TIMELY], spread_rows=True)
    received, line = F.col("Date received"), F.col("Complaint ID") % 10
    segment, response = F.col("Tags"), F.col(RESPONSE)
    return df.select(
        F.when(line == 2, F.date_format(received, "M/d/yyyy"))
        .when(line == 3, F.date_format(received, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(line == 7, "not a date")
        .otherwise(F.date_format(received, "yyyy-MM-dd")).alias("Date received"),
        F.concat(F.lit("  "), "Product", F.lit("\t ")).alias("Product"),
        F.when(F.col("Product") == "PROMO", "N/A").otherwise(F.col("Product")).alias("Sub-product"),
        F.when(F.col("Issue") == "Brand#1", "NA").otherwise(F.col("Issue")).alias("Issue"),
        F.when(F.col("Sub-issue") == "red widget", "").otherwise(F.col("Sub-issue")).alias("Sub-issue"),
        F.when(response == "R", " \n ").when(response == "N", F.concat_ws("  ", "Sub-issue", "Company")).alias(NARRATIVE),
        F.lit(None).cast("string").alias("Company public response"),
        F.col("Company"),
        F.when(F.col("State") == "NATION_1", "null").otherwise(F.col("State")).alias("State"),
        F.lit("nan").alias("ZIP code"),
        F.when(segment == "BUILDING", "Older American, Servicemember").when(segment == "MACHINERY", "")
        .otherwise(segment).alias("Tags"),
        F.col("Submitted via"),
        F.date_format("Date sent to company", "MM/dd/yyyy").alias("Date sent to company"),
        F.when(response == "A", "None").otherwise(response).alias(RESPONSE),
        F.col(TIMELY),
        F.col("Complaint ID").cast("string").alias("Complaint ID"),
    )


@query("preprocess")
def _(spark, folder):
    df = ingest.preprocess(raw_complaints(spark, folder))
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ingest.DATE_COLUMNS})


def csv_deliveries(spark: SparkSession, folder: str) -> str:
    """The raw complaints as CSV files with three headers, and a file of short lines (a date and a name) and overlong ones."""
    raw = stage(raw_complaints(spark, folder).withColumn("Extra", F.lit("surplus")), "raw-complaints")
    names = list(RAW_COLUMNS)
    target = f"{checkpoint_folder(spark).rstrip('/')}/casemill/csv-{uuid.uuid4().hex}"
    options = dict(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for k, order in enumerate((names, names[::-1], ["Extra", *names[3:], *names[:3]])):
        raw.where(F.col("Complaint ID").cast("bigint") % 3 == k).select(*order).write.options(**options).csv(f"{target}/{k}")
    lines = F.array_sort(F.collect_list(F.concat(F.lit("2021-05-01,"), "n_name")))
    overlong = F.collect_list(F.concat_ws(",", *["n_name"] * (len(names) + 1)))
    table(spark, folder, "nation").agg(F.concat_ws("\n", F.lit(",".join(names)), overlong, lines)).write.text(f"{target}/lines")
    return f"{target}/*"


@query("csv_ingest")
def _(spark, folder):
    """Raw files of several layouts, read by their own headers and processed. Short lines stay, overlong ones go."""
    df = ingest.preprocess(read_raw_csv(spark, csv_deliveries(spark, folder))).drop("Extra", ROW_ORDER)
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ingest.DATE_COLUMNS})


@query("trim_fill")
def _(spark, folder):
    df = ingest.null_na_tokens(raw_complaints(spark, folder).select("Product", "Issue", "Sub-issue", "State", "Tags"))
    df = ingest.fill_missing(ingest.clean_text_columns(df))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("Count"))


over_cases("date_parts", ["Complaint ID", "Year", "Month", "Quarter", "Day", "Day_Name"], lambda df: df)
over_cases("resolution_delay", ["Complaint ID", "Resolution_Delay"], lambda df: df)


@query("text_features")
def _(spark, folder):
    c = F.col(NARRATIVE)
    return document_narratives(spark, folder).select(
        "doc_id", c.isNotNull().cast("int").alias("Has_Narrative"), text.char_count(c).alias("Narrative_Length"),
        text.word_count(c).alias("Narrative_Word_Count"), labels.complexity(text.word_count(c)).alias("Complexity"),
    )


@query("value_replace")
def _(spark, folder):
    names = {"BUILDING": "Builders", "MACHINERY": "Machine makers"}
    df = cases(spark, folder, ["Complaint ID", "Tags"])
    return df.select("Complaint ID", ingest.replace_values(F.col("Tags"), names).alias("Consumer_Group"))


@query("dedupe_first")
def _(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"
    )
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")]
    first = ingest.dedupe_first(df, ["l_orderkey", "l_linenumber"], order)
    return first.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("clean_text")
def _(spark, folder):
    return words.with_clean_text(document_narratives(spark, folder), NARRATIVE, drop_empty=True).select(
        "doc_id", "clean_text"
    )


def _documents_with_labels(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


query("null_profile")(lambda spark, folder: profile.null_profile(_documents_with_labels(spark, folder)))
query("duplicate_rows")(lambda spark, folder: profile.duplicate_rows(
    table(spark, folder, "documents").select("text", "lang", "source")))
query("distinct_and_nulls")(lambda spark, folder: profile.distinct_and_nulls(
    _documents_with_labels(spark, folder), ["lang", "source", "quality", "toxic"]))
query("counts_with_nulls")(lambda spark, folder: counts.value_counts(
    _documents_with_labels(spark, folder), "quality", nulls=True))
over_cases("describe_delay", ["Resolution_Delay"], lambda df: profile.describe(df, "Resolution_Delay"))
query("describe_price")(lambda spark, folder: profile.describe(table(spark, folder, "lineitem"), "l_extendedprice"))
query("describe_text_length")(lambda spark, folder: profile.describe(
    document_narratives(spark, folder).select(text.char_count(F.col(NARRATIVE)).alias("n")), "n"))


@query("date_range")
def _(spark, folder):
    df = raw_complaints(spark, folder).select(dates.parse_timestamp(F.col("Date received")).alias("d"))
    return profile.date_range(df, "d").withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("First", "Last")}
    )


# Taxonomy ------------------------------------------------------------------------------------------


def named_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with historic product and issue names: the size of the part picks the name, and parts beyond
    the list of names keep their own type and brand."""
    parts = table(spark, folder, "part").select(
        "p_partkey", *[
            F.coalesce(F.get(F.array(*[F.lit(n) for n in taxonomy.raw_labels(field)]), F.col("p_size") - 1), F.col(own))
            .alias(field) for field, own in (("Product", "p_type"), ("Issue", "p_brand"))
        ],
    )
    lines = table(spark, folder, "lineitem").select("l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("Product", "Issue")


@query("canonicalize")
def _(spark, folder):
    df = named_cases(spark, folder).withColumns({
        "Product_canonical": taxonomy.canonical_product(F.concat(F.lit(" "), "Product")),
        "Issue_canonical": taxonomy.canonical_issue(F.concat(F.col("Issue"), F.lit("  "))),
    })
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("Count"))


@query("canonicalize_by_table")
def _(spark, folder):
    return taxonomy.canonical_counts(named_cases(spark, folder), "Issue", taxonomy.dimension(spark, "Issue"), "Issue_canonical")


def _audit(field: str, fn: Callable[[Column], Column]) -> Query:
    return lambda spark, folder: taxonomy.audit(taxonomy.label_support(named_cases(spark, folder), field), fn)


query("product_taxonomy_audit")(_audit("Product", taxonomy.canonical_product))
query("taxonomy_audit")(_audit("Issue", taxonomy.canonical_issue))


@query("taxonomy_merged_groups")
def _(spark, folder):
    support = taxonomy.label_support(named_cases(spark, folder), "Issue")
    groups = taxonomy.merged_groups(support, taxonomy.canonical_issue)
    return groups.select("canonical_label", F.explode("raw_components").alias("m"), "combined_support").select(
        "canonical_label", "m.label", "m.support", "combined_support"
    )


@query("taxonomy_report")
def _(spark, folder):
    """The report with the rows of every canonical label."""
    support = counts.value_counts(
        named_cases(spark, folder).select(taxonomy.canonical_issue(F.col("Issue")).alias("c")), "c", count="support"
    )
    rows = taxonomy.report(spark, "Issue").join(support, F.col("canonical_label") == F.col("c"), "left").drop("c")
    return rows.withColumn("raw_labels", F.array_join("raw_labels", "; ")).na.fill({"support": 0})


# Evaluation ----------------------------------------------------------------------------------------


def stand_in_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A predicted name per order line: the true one, one with the same first word, or a longer one."""
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_discount", "l_tax")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    df = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    name = F.col("p_name")
    guess = (
        F.when(F.col("l_discount") >= 0.05, name)
        .when(F.col("l_tax") >= 0.04, F.concat(F.split_part(name, F.lit(" "), F.lit(1)), F.lit(" widget")))
        .otherwise(F.concat(F.lit("large "), name))
    )
    kind = F.when(F.col("l_discount") >= 0.05, F.col("p_type")).otherwise("STANDARD")
    return df.select(name.alias("y_true"), guess.alias("y_pred"), F.col("p_type").alias("type"), kind.alias("type_pred"))


def _pairs(spark, folder):
    return evaluate.confusion(stand_in_predictions(spark, folder))


query("confusion_pairs")(_pairs)
query("confusion_matrix")(lambda spark, folder: evaluate.confusion_matrix(
    evaluate.confusion(stand_in_predictions(spark, folder), "type", "type_pred")))
query("accuracy")(lambda spark, folder: evaluate.accuracy(_pairs(spark, folder)))
query("per_class_report")(lambda spark, folder: evaluate.per_class(_pairs(spark, folder)))
query("macro_weighted")(lambda spark, folder: evaluate.averages(_pairs(spark, folder)))
query("confused_pairs")(lambda spark, folder: evaluate.confused_pairs(_pairs(spark, folder)))

# Class names for the 64 positions of an embedding: the historic issue names, then numbered ones.
CLASSES = [*taxonomy.raw_labels("Issue"), *[f"Class {i}" for i in range(len(taxonomy.raw_labels("Issue")), 64)]]
ISSUE_NAMES = {raw: name for name, raws, _, _ in taxonomy.ISSUE_GROUPS for raw in raws}


def class_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as probabilities of 64 classes: the eighth power of every component, scaled to the sum 1."""
    def eighth(x: Column) -> Column:
        d = x.cast("double")
        return d * d * d * d * d * d * d * d

    def scaled(w: Column) -> Column:
        return let(F.aggregate(w, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(w, lambda x: x / total))

    probability = let(F.transform("embedding", eighth), scaled)
    return table(spark, folder, "embeddings").select("vec_id", "label", probability.alias("probability"))


def _scored(spark, folder):
    scores = predictions.canonical_scores(F.col("probability"), CLASSES, ISSUE_NAMES)
    return class_probabilities(spark, folder).withColumn("scores", scores)


@query("top_k_accuracy")
def _(spark, folder):
    names = F.array(*[F.lit(c) for c in CLASSES])
    df = class_probabilities(spark, folder).withColumn("y_true", F.get(names, F.col("label")))
    return evaluate.top_k_accuracy(df, "probability", CLASSES)


@query("canonical_probabilities")
def _(spark, folder):
    return _scored(spark, folder).select("vec_id", F.inline("scores")).select("vec_id", "label", "confidence")


@query("confidence_decision")
def _(spark, folder):
    raw = predictions.raw_label(F.col("probability"), CLASSES)
    df = _scored(spark, folder).select("vec_id", predictions.confidence_decision(F.col("scores"), raw).alias("p"))
    alternative = [F.get("p.alternatives", F.lit(i))[f].alias(f"alternative_{i + 1}_{f}")
                   for i in range(2) for f in ("label", "confidence")]
    return df.select("vec_id", "p.label", "p.confidence", "p.raw_label", "p.decision", *alternative)


@query("decision_counts")
def _(spark, folder):
    raw = predictions.raw_label(F.col("probability"), CLASSES)
    df = _scored(spark, folder).select(predictions.confidence_decision(F.col("scores"), raw)["decision"].alias("Decision"))
    return counts.value_counts(df, "Decision")


@query("multi_issue_candidates")
def _(spark, folder):
    record = predictions.multi_issue_record(F.col("scores"))
    df = _scored(spark, folder).select("vec_id", record.alias("r"))
    every = F.concat(F.array("r.primary_issue"), F.col("r.additional_candidate_issues"))
    return df.select("vec_id", F.posexplode(every).alias("position", "c")).select(
        "vec_id", (F.col("position") + 1).alias("position"), "c.label", "c.confidence", "c.is_heuristic"
    )


# Topics --------------------------------------------------------------------------------------------


def _topics(spark, folder, where: Column | None = None) -> DataFrame:
    df = class_probabilities(spark, folder)
    df = df if where is None else df.filter(where)
    return topics.prevalence(df.select(topics.dominant_topic(F.col("probability")).alias("t")), "t", 64)


@query("document_topic")
def _(spark, folder):
    return topics.document_topics(class_probabilities(spark, folder).drop("label"), "probability")


def _emerging(spark, folder):
    early = F.col("label") < 5
    return topics.emerging(_topics(spark, folder, ~early), _topics(spark, folder, early), P.emerging_growth)


query("topic_prevalence")(_topics)
query("emerging_topics")(lambda spark, folder: topics.with_labels(_emerging(spark, folder)))


@query("recurring_themes")
def _(spark, folder):
    ids = topics.topic_ids(table(spark, folder, "embeddings"), 64)
    return topics.discovery_report(ids, _topics(spark, folder))["recurring_themes"]


# Samples, splits, similar documents ----------------------------------------------------------------


@query("seeded_sample")
def _(spark, folder):
    return sampling.sample_rows(document_narratives(spark, folder), 300, "doc_id").select("doc_id", "Product")


@query("stratified_split")
def _(spark, folder):
    train, test = sampling.stratified_split(document_narratives(spark, folder), "Product", "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select(
        "doc_id", "Product", "part"
    )


query("rare_class_filter")(lambda spark, folder: sampling.keep_frequent(
    document_narratives(spark, folder), "Product", 100).select("doc_id", "Product"))


@query("similar_topn")
def _(spark, folder):
    """For every benchmark text the five most similar documents, with every term that at least three hold."""
    texts = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    corpus = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return similar.similar_texts(texts, corpus, "text").select(
        "query_id", "doc_id", "rank", "similarity"
    )


@query("narrative_extract")
def _(spark, folder):
    """Documents with a label as narratives that have text, product and issue; the product is missing without a label."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    df = document_narratives(spark, folder).join(labels, "doc_id", "left")
    df = df.withColumn("Product", F.when(F.col("quality").isNotNull(), F.col("Product")))
    return narratives(df, ["doc_id"]).select("doc_id", "Product", "Issue")


def _report_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Per-class rows of the stand-in predictions as the lines of a saved report."""
    rows = evaluate.per_class(_pairs(spark, folder))
    cells = [F.format_string("%.2f", F.round(c, 2)) for c in ("precision", "recall", "f1_score")]
    return rows.select(F.lit("report").alias("file"), F.concat_ws("  ", F.lit(" "), "label", *cells, F.col("support").cast("string")).alias("value"))


@query("report_rows")
def _(spark, folder):
    return reports.parse_class_rows(_report_lines(spark, folder)).drop("file")


@query("report_headlines")
def _(spark, folder):
    """Averages of the stand-in predictions, written as the head of a report and read back."""
    right = evaluate.accuracy(_pairs(spark, folder)).scalar()
    rows = evaluate.per_class(_pairs(spark, folder)).agg(
        F.avg("f1_score").alias("macro"), (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("weighted"),
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall")).withColumn("accuracy", right)
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.format_string("%.4f", F.round(c, 4)))
    text = F.concat_ws("\n", line("Accuracy", "accuracy"), line("Macro F1", "macro"), line("Weighted F1", "weighted"),
                       line("Macro Precision", "precision"), line("Macro Recall", "recall"))
    heads = reports.parse_headlines(rows.select(F.lit("report").alias("file"), text.alias("text")))
    return heads.select("format", "accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall")


@query("training_class_counts")
def _(spark, folder):
    df = named_cases(spark, folder).withColumn("clean_text", F.lit("text"))
    return classify.class_counts(classify.labelled(df, "Issue", taxonomy.canonical_issue), "Issue")


@query("class_balance")
def _(spark, folder):
    """Rows and balanced weight of each label, as the classifier uses them."""
    return classify.balance(document_narratives(spark, folder).select(F.col("Product").alias("label")))


# Trained models ------------------------------------------------------------------------------------

# Fitting to the tolerance takes some 800 steps here (3 minutes for each model); 100 steps are the stated bound of these
# queries, and a fit that reaches its bound warns.
MODEL = Params(min_class_rows=20, max_iter=100)
_models: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, name: str, fit: Callable[[], object]) -> object:
    """A model that several queries use is fitted once in a session; its tables lie in the shared folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _models:
        _models[key] = fit()
    return _models[key]


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    df = document_narratives(spark, folder)
    return classify.text_rows(df, NARRATIVE).select(
        "doc_id", "clean_text", "Product", "Issue"
    )


def _stored_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned texts, stored once in a session: sampling, splitting, fitting and scoring go over them many times."""
    return _once(spark, folder, "texts", lambda: stage(_texts(spark, folder), "clean-texts"))


def _judged_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The texts with what ``labels`` says of some of them as the issue: a source says nothing about a text's words."""
    judged = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "weak")
    labels_ = table(spark, folder, "labels").select("doc_id", judged.alias("Issue"))
    return _stored_texts(spark, folder).drop("Issue").join(labels_, "doc_id", "left")


def _classifier(spark: SparkSession, folder: str, target: str) -> classify.Classifier:
    canonical, texts = {"Product": (taxonomy.canonical_product, _stored_texts), "Issue": (taxonomy.canonical_issue, _judged_texts)}[target]
    p = MODEL if target == "Product" else replace(MODEL, min_class_rows=2)  # labels are few in the smallest tables
    return _once(spark, folder, target, lambda: classify.train_classifier(texts(spark, folder), target, "doc_id", canonical, p))


@query("tfidf_classifier")
def _(spark, folder):
    return evaluate.averages(evaluate.confusion(_classifier(spark, folder, "Product").test))


@query("tfidf_weights")
def _(spark, folder):
    """TF-IDF weights of the 2,000 most frequent terms in every document."""
    texts = _texts(spark, folder)
    counts = stage(tables.term_lists(texts, "doc_id", P), "term-lists").select("doc_id", F.inline("terms"))
    return tables.weights(counts, tables.vocabulary(counts, texts.agg(F.count(F.lit(1))).scalar(), 2000, P)).select("doc_id", "term", "weight")


@query("classifier_grid")
def _(spark, folder):
    texts = _stored_texts(spark, folder).where(F.length("clean_text") > 0)
    return classify.tune_classifier(texts, "Product", "doc_id", MODEL)[1]


@query("scored_texts")
def _(spark, folder):
    model = _classifier(spark, folder, "Product")
    return classify.score_texts(model, _stored_texts(spark, folder), {}, MODEL).select("doc_id", "prediction.label", "prediction.decision")


def analysis_tables(spark: SparkSession, folder: str) -> tables.Analysis:
    """Product classifier, issue classifier and topics as tables."""
    return _once(spark, folder, "analysis", lambda: tables.Analysis(
        tables.linear_table(_classifier(spark, folder, "Product")), tables.linear_table(_classifier(spark, folder, "Issue")),
        tables.topic_table(_topic_model(spark, folder)[0])))


@query("analyzed_texts")
def _(spark, folder):
    """Product, issue and topic of every text that is not empty, from the tables of three fitted models."""
    found = tables.analyzed(_stored_texts(spark, folder).select("doc_id", "clean_text"), "doc_id", analysis_tables(spark, folder), {}, {}, MODEL)
    return found.select(
        "doc_id", *[F.col(f"{m}.{c}").alias(f"{m}_{c}") for m in ("product", "issue") for c in ("label", "confidence", "decision")],
        F.size("multi_issue.additional_candidate_issues").alias("additional_issues"), "topic_id", "confidence")


def _topic_model(spark, folder):
    texts = _stored_texts(spark, folder)
    return _once(spark, folder, "topics", lambda: classify.train_topics(texts, MODEL)), texts


@query("lda_topics")
def _(spark, folder):
    return topics.with_labels(_topic_model(spark, folder)[0].words)


@query("doc_topic")
def _(spark, folder):
    model, texts = _topic_model(spark, folder)
    return model.predict(texts).select("doc_id", "topic_id", "confidence", "topic_words")
