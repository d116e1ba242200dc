"""Summaries that follow new rows: each step's cube is worked out once, and readers add the cubes up.

``add_step`` stores, under the number of the step, the additive states of the rows whose id no earlier step has, and those
ids. Of the history only the ids are read; they stay where they are while the step is small enough to be sent to
them. The ids alone tell which rows come again; whole rows are moved or sorted only where some do. A step that is repeated finds
the same rows new and overwrites what it stored, so it counts once however often it is tried.
``merge_steps`` stores the sum of the steps so far beside them; readers take the last sum and the steps after it. What a
failed job left without its success mark is never read.

Rows: of one id the first in the order of steps counts, within a step the first by ``order``; rows without id count as one id,
as in ``ingest``. An empty step stores no states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.operators.facts import CUBE_KEYS, CUBE_SETS, SET_ID, CubeFacts, grouped_sets
from casemill.operators.ingest import dedupe_first
from casemill.session import shuffles_removed, stage, staged_tables_removed
from casemill.sources.complaints import save_table

ID = "Complaint ID"
STEP, SUM, PART = "step", "upto", "_part"


def _committed(spark: SparkSession, folder: str, kind: str) -> dict[int, str]:
    """The folders ``kind=number`` whose job ended."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    paths = [s.getPath().getParent() for s in found]
    return {int(p.getName().split("=")[1]): p.toString() for p in paths}


def _first_rows(rows: DataFrame, earlier: Sequence[str], order: Sequence[Column], part: int | None = None) -> DataFrame:
    """The first row of every id that the tables ``earlier`` do not hold, of which only ``part`` is read."""
    asked = rows.select(F.col(ID).alias("_asked"))
    again = asked.groupBy(F.col("_asked").alias("_id")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_id", F.lit(False).alias("_known"))
    if earlier:
        spark = rows.sparkSession
        if part is None:
            known = spark.read.parquet(*earlier)
        else:
            known = spark.read.option("basePath", earlier[0].rsplit("/", 1)[0]).parquet(*earlier).where(F.col(PART) == part)
        known = known.select(F.col(ID).alias("_id"))
        known = known.join(asked, F.col("_id").eqNullSafe(F.col("_asked")), "left_semi").select("_id", F.lit(True).alias("_known"))
        again = again.union(known).groupBy("_id").agg(F.max("_known").alias("_known"))
    again = stage(again, "step-ids-again")
    if again.isEmpty():
        return rows
    same = F.col(ID).eqNullSafe(F.col("_id"))
    several = dedupe_first(rows.join(again.where("not _known"), same, "left_semi"), [ID], order)
    return rows.join(again, same, "left_anti").unionByName(several)


def add_step(
    rows: DataFrame | Sequence[DataFrame], target: str, step: int, order: Sequence[Column] = (), sets: Sequence[Sequence[str]] = CUBE_SETS,
) -> None:
    """Add the processed ``rows`` of a step, a stored table, since it is read a few times. Steps come in ascending order; the last
    one may be repeated. Instead of one table there may be parts that share no id, the same way in every step: then no more
    than a part of the rows is moved at a time."""
    parts = {None: rows} if isinstance(rows, DataFrame) else dict(enumerate(rows))
    one = next(iter(parts.values()))
    spark, target = one.sparkSession, target.rstrip("/")
    columns = [c for c in one.columns if c in CUBE_KEYS or c in ("Resolution_Delay", "Narrative_Word_Count", "Narrative_Length")]
    with staged_tables_removed(spark), shuffles_removed(spark):
        earlier = [path for k, path in _committed(spark, f"{target}/ids", STEP).items() if k < step]
        first = None
        for number, part in parts.items():
            found = _first_rows(part, earlier, order or [F.col(ID)], number)
            new = found.select(ID, *columns) if found is part else stage(found.select(ID, *columns), "step-rows")  # read twice
            new = new if number is None else new.withColumn(PART, F.lit(number))
            first = new if first is None else first.unionByName(new)
        save_table(grouped_sets(first, sets), f"{target}/cube/{STEP}={step}")
        ids = [PART] if PART in first.columns else []
        save_table(first.select(ID, *ids), f"{target}/ids/{STEP}={step}", partition_by=ids)


def _added_up(spark: SparkSession, target: str, upto: int | None = None) -> tuple[DataFrame, int]:
    folder = f"{target.rstrip('/')}/cube"
    wanted = lambda kind: {k: p for k, p in _committed(spark, folder, kind).items() if upto is None or k <= upto}
    sums, steps = wanted(SUM), wanted(STEP)
    base = max(sums, default=-1)
    paths = ([sums[base]] if base in sums else []) + [p for k, p in sorted(steps.items()) if k > base]
    if not paths:
        raise ValueError(f"no steps under {target}")
    parts = spark.read.parquet(*paths)
    keys = [c for c in parts.columns if c in CUBE_KEYS or c == SET_ID]
    states = [F.sum(c).alias(c) for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*states), max([base, *steps])


def stored_cube(spark: SparkSession, target: str) -> CubeFacts:
    """The facts of all steps so far."""
    return CubeFacts(stage(_added_up(spark, target)[0], "stored-cube"))


def merge_steps(spark: SparkSession, target: str, upto: int | None = None) -> int:
    """Store the sum of all steps, or of those up to a number; the number of the last one comes back."""
    total, last = _added_up(spark, target, upto)
    save_table(total, f"{target.rstrip('/')}/cube/{SUM}={last}")
    return last
