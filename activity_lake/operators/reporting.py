"""Reporting tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from activity_lake.operators.cdc import latest_state
from activity_lake.operators.quality import rank, ranked_status

# Fixed value: flag of a sport on the official list.
OFFICIAL = 1


def official_sports(sports: DataFrame) -> DataFrame:
    return sports.filter(F.col("strava_list") == OFFICIAL).select("sport")


def with_templates(sports: DataFrame) -> DataFrame:
    """The list of situation templates as an array."""
    return sports.withColumn("templates", F.split("templates", r"\|"))


def social_year_stats(gold: DataFrame) -> DataFrame:
    """Activities, metres and seconds per employee and social year."""
    return gold.groupBy("employee_id", "social_year").agg(
        F.count("*").alias("activities"),
        F.sum("distance_meters").alias("distance_meters"),
        F.sum("duration_sec").alias("duration_sec"),
    )


def bonus_what_if(employees: DataFrame, rates: list[str]) -> DataFrame:
    """Total bonus for each candidate rate.

    The eligible payroll is summed once, exactly; the rates apply to that one row.
    """
    payroll = employees.filter("is_eligible_bonus").agg(
        F.count("*").alias("employees"),
        F.coalesce(F.sum(F.col("salary").cast("decimal(10,2)")), F.lit(Decimal("0.00"))).alias("payroll"),
    )
    listed = F.array(*[F.lit(r).cast("decimal(6,4)") for r in rates])
    spread = payroll.withColumn("rate", F.explode(listed))
    return spread.select(
        F.col("rate").cast("double").alias("rate"), "employees",
        (F.col("payroll") * F.col("rate")).cast("double").alias("total_bonus"),
    )


def employee_sheet(
    employees: DataFrame, gold: DataFrame | None, comments: DataFrame, stats: DataFrame | None = None
) -> DataFrame:
    """One row per employee: bonus, activity totals and the latest comment.

    ``gold`` and ``comments`` are reduced to one row per employee before the
    joins. ``comments`` has ``employee_id, begin_date, id, comment``. Totals that
    are kept up to date, as ``stats`` per employee and social year, take the
    place of ``gold``, which is then not read.
    """
    if stats is None:
        counts = [F.count("*").alias("activities"), F.count_distinct("social_year").alias("social_years")]
    else:
        counts = [F.sum("activities").alias("activities"), F.count("social_year").alias("social_years")]
    totals = (gold if stats is None else stats).groupBy("employee_id").agg(
        *counts, F.sum("distance_meters").alias("distance_meters"), F.sum("duration_sec").alias("duration_sec"))
    last = latest_state(comments, "employee_id", ("begin_date", "id")).select(
        "employee_id", F.col("comment").alias("last_comment"))
    sheet = (
        employees.withColumnRenamed("id", "employee_id")
        .join(totals, "employee_id", "left").join(last, "employee_id", "left")
    )
    return sheet.fillna(0, ["activities", "social_years", "distance_meters", "duration_sec"])


def token_report(log: DataFrame) -> DataFrame:
    """Token use per session. The operation names."""
    indexing = F.col("operation") == "vectorization"
    asking = F.col("operation").isin("search", "chat")

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    sums = log.groupBy("session_id").agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count_if(indexing).alias("vectorizations"),
        total("chunks", indexing).alias("chunks"),
        total("tokens", indexing).alias("vector_tokens"),
        F.count_if(asking).alias("searches"),
        total("total_tokens", asking).alias("search_tokens"),
    )

    def average(tokens: str, parts: str) -> Column:
        return F.coalesce(F.try_divide(tokens, parts), F.lit(0.0))

    return sums.withColumns({
        "avg_tokens_per_chunk": average("vector_tokens", "chunks"),
        "avg_tokens_per_search": average("search_tokens", "searches"),
        "total_tokens": F.col("vector_tokens") + F.col("search_tokens"),
    })


def rollup(steps: DataFrame, run: str = "run") -> DataFrame:
    """Overall status of each run: the worst of its steps."""
    return steps.groupBy(run).agg(ranked_status(F.max(rank(F.col("status")))).alias("status"))


def alerts(runs: DataFrame) -> DataFrame:
    """Runs that call for a message."""
    return runs.filter(F.col("status") != "SUCCESS")


def run_metrics(df: DataFrame) -> DataFrame:
    """Shape of a stage: one row with its rows and columns."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while some later action writes them."""
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("rows")), seen


def step_durations(log: DataFrame, step: list[str], started: str, ended: str) -> DataFrame:
    """First start, last end and elapsed microseconds of each step."""
    spans = log.groupBy(*step).agg(F.min(started).alias("started"), F.max(ended).alias("ended"))
    return spans.withColumn("elapsed_micros", F.timestamp_diff("MICROSECOND", "started", "ended"))
