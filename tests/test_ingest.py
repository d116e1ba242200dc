import csv
import re

import pytest
from pyspark.sql import functions as F

from casemill.operators.ingest import dedupe_first, ingest, preprocess
from casemill.sources.complaints import (
    NARRATIVE, RAW_COLUMNS, first_rows, narratives, read_raw_csv, require_columns, require_rows, save_summary,
)
from casemill.streaming.ingest import ingest_available, stored_cases


def record(**changes):
    row = dict.fromkeys(RAW_COLUMNS, "sample")
    row.update({"Date received": "2021-05-01", "Date sent to company": "2021-05-03", "Complaint ID": "1",
                "Tags": "", "State": "NA", "Timely response?": "Yes", NARRATIVE: "I was\ncharged \"twice\", again"})
    return {**row, **changes}


def write(path, rows, extra_lines=()):
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, RAW_COLUMNS)
        writer.writeheader()
        writer.writerows(rows)
        f.writelines(extra_lines)


def test_csv_to_processed(spark, tmp_path):
    rows = [
        record(), record(**{"Complaint ID": "2", NARRATIVE: "   ", "Product": "  Loan "}),
        record(**{"Complaint ID": "3", NARRATIVE: "", "Issue": "", "Tags": "Older American, Servicemember"}),
        record(**{"Complaint ID": "1", "Product": "second"}),
        record(**{"Complaint ID": "4", "Date received": "05/04/2021", "Date sent to company": "junk", "Company": "null"}),
    ]
    overlong = ",".join(["x"] * 15 + ["9", "surplus"]) + "\r\n"
    short = "2021-05-01,Short\r\n"
    write(tmp_path / "a.csv", rows, [overlong, short])
    out = {r["Complaint ID"]: r for r in ingest(read_raw_csv(spark, str(tmp_path / "a.csv"))).collect()}
    assert set(out) == {"1", "2", "3", "4", None}
    one = out["1"]
    assert one["Product"] == "sample" and one["Narrative_Word_Count"] == 5 and one["Has_Narrative"] == 1
    assert (one["Year"], one["Month"], one["Quarter"], one["Day"], one["Day_Name"]) == (2021, 5, 2, 1, "Saturday")
    assert one["Resolution_Delay"] == 2 and one["State"] == "Unknown" and one["Consumer_Group"] == "Normal Consumer"
    blank = out["2"]
    assert blank[NARRATIVE] == "" and blank["Has_Narrative"] == 1 and blank["Narrative_Word_Count"] == 0
    assert blank["Product"] == "Loan"
    assert out["3"]["Has_Narrative"] == 0 and out["3"]["Issue"] == "Unknown"
    assert out["3"]["Consumer_Group"] == "Older American + Servicemember"
    assert out["4"]["Resolution_Delay"] is None and out["4"]["Company"] is None and out["4"]["Month"] == 5
    assert out[None]["Product"] == "Short" and out[None]["Company"] is None


def test_missing_column(spark):
    df = spark.createDataFrame([("x",)], "Company string")
    with pytest.raises(ValueError, match="Product"):
        require_columns(df)
    with pytest.raises(ValueError):
        preprocess(df)
    with pytest.raises(ValueError):
        require_rows(df.filter("false"))


def test_dedupe_keeps_first_of_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (30_000 - F.col("id")).alias("o")
    )
    out = dedupe_first(df, ["k"], [F.col("o")])
    assert out.count() == 20_001
    assert out.filter("k = -1").first()["o"] == 3
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_narratives_and_summary_sink(spark, tmp_path):
    df = spark.createDataFrame([("t", "p", "i", 1), (None, "p", "i", 2), ("t", None, "i", 3)],
                               f"`{NARRATIVE}` string, Product string, Issue string, id int")
    assert [r["id"] for r in narratives(df, ["id"]).collect()] == [1]
    save_summary(df, str(tmp_path), "s")
    assert spark.read.parquet(str(tmp_path / "s.parquet")).count() == 3
    assert first_rows(df, 2).count() == 2


def test_incremental_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    write(source / "a.csv", [record(), record(**{"Complaint ID": "2"})])
    ingest_available(spark, str(source), target, state).awaitTermination()
    write(source / "b.csv", [record(Product="later"), record(**{"Complaint ID": "3"})])
    ingest_available(spark, str(source), target, state).awaitTermination()
    out = {r["Complaint ID"]: r for r in stored_cases(spark, target).collect()}
    assert set(out) == {"1", "2", "3"} and out["1"]["Product"] == "sample"


def write_as(path, names, rows):
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, names)
        writer.writeheader()
        writer.writerows([{n: r.get(n, "surplus") for n in names} for r in rows])


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.csv", [record()])
    write_as(source / "b.csv", RAW_COLUMNS[::-1], [record(**{"Complaint ID": "2", "Product": "reversed"})])
    write_as(source / "c d.csv", ["Extra", *RAW_COLUMNS[3:], *RAW_COLUMNS[:3]], [record(**{"Complaint ID": "3", "Product": "wider"})])
    out = {r["Complaint ID"]: r for r in ingest(read_raw_csv(spark, str(source))).collect()}
    assert {k: r["Product"] for k, r in out.items()} == {"1": "sample", "2": "reversed", "3": "wider"}
    assert all(r["Resolution_Delay"] == 2 for r in out.values()) and out["3"]["Extra"] == "surplus" and out["1"]["Extra"] is None
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest_available(spark, str(source), target, state).awaitTermination()
    stored = {r["Complaint ID"]: r["Product"] for r in stored_cases(spark, target).collect()}
    assert stored == {"1": "sample", "2": "reversed", "3": "wider"}
    write_as(source / "d.csv", RAW_COLUMNS[1:], [record()])
    with pytest.raises(ValueError, match="Date received"):
        read_raw_csv(spark, str(source))
    with pytest.raises(Exception, match="Date received"):
        ingest_available(spark, str(source), target, state).awaitTermination()


def test_headers_of_two_lines_and_packed_files(spark, tmp_path):
    import gzip
    names = ["Odd\nname", *RAW_COLUMNS]
    write_as(tmp_path / "a.csv", names, [record()])
    write_as(tmp_path / "b.csv", names[::-1], [record(**{"Complaint ID": "2"})])
    with gzip.open(tmp_path / "c.csv.gz", "wb") as f:
        f.write((tmp_path / "b.csv").read_bytes())
    (tmp_path / "empty.csv").touch()
    out = preprocess(read_raw_csv(spark, str(tmp_path)))  # strips the \r that is left where a line break in a name is a bare \n
    assert sorted((r["Complaint ID"], r["Odd\nname"], r["Product"]) for r in out.collect()) == [
        ("1", "surplus", "sample"), ("2", "surplus", "sample"), ("2", "surplus", "sample")]


def test_no_method_of_the_stage_is_too_long_for_the_compiler(spark, tmp_path):
    """HotSpot leaves methods of more than 8,000 bytes interpreted; the one of this stage is longer."""
    write(tmp_path / "a.csv", [record()])
    processed = preprocess(read_raw_csv(spark, str(tmp_path / "a.csv")))
    code = spark._jvm.PythonSQLUtils.explainString(processed._jdf.queryExecution(), "codegen")
    longest = max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    assert min(longest, int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))) <= 8000
