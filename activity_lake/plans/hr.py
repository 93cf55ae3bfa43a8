"""HR ingestion: two sheets to the employees table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.functions.business import margin_kms, with_distance
from activity_lake.functions.dates import full_years
from activity_lake.functions.privacy import decrypt, drop_pii, encrypt
from activity_lake.operators.quality import (
    FAILED, SUCCESS, WARNING, orphan_sports, publish, reconcile, status_of,
)
from activity_lake.operators.shaping import merge_hr_sport
from activity_lake.plans.runs import RunLog
from activity_lake.plans.suites import hr_suite, sport_suite
from activity_lake.session import new_path
from activity_lake.sources.tables import (
    is_empty, job_stages, path_missing, table_append, table_scan, write_stage,
)

# Columns of the employees table, in its order.
EMPLOYEE_COLUMNS = [
    "id", "last_name", "first_name", "age", "business_unit", "seniority_years", "vacation_days",
    "employement_contract", "salary", "transport_mode", "distance_kms", "margin_kms", "sport_type",
]


def transform_hr(
    raw: DataFrame, geo: DataFrame, company: tuple[float, float], as_of: str, policy: str = "All"
) -> DataFrame:
    """Distance, margin, age and seniority; columns used up for them are dropped."""
    placed = with_distance(raw, geo, company, policy)
    derived = placed.withColumns({
        "margin_kms": margin_kms("transport_mode", "distance_kms"),
        "age": full_years("birthday", as_of),
        "seniority_years": full_years("entry_date", as_of),
    })
    return drop_pii(derived)


def ingest_hr(
    raw: DataFrame,
    sport: DataFrame,
    geo: DataFrame,
    sports: DataFrame,
    company: tuple[float, float],
    as_of: str,
    key: str,
    target: str | dict,
    policy: str = "All",
    account: str | None = None,
    log: RunLog | None = None,
) -> dict[str, str]:
    """Transform, audit, merge, reconcile and append; returns the step statuses.

    Nothing is appended once a step has failed. Employees that ``target`` has
    already are not appended again; ``load`` is then a WARNING. Names are
    encrypted before anything is written, the address never is written.
    ``account`` is a folder for what the run did: all violations of both
    sheets, the rows ``dropped``, the ``orphans`` among the sports and the ids
    ``known`` before. Every step leaves a row in the run table of ``log``, by
    default in ``account``. Stages are removed at the end.
    """
    spark = raw.sparkSession
    account = account or new_path(spark, "hr-account")
    log = log or RunLog(spark, f"{account}/runs", "ingest_hr")
    with job_stages(spark):
        return _ingest(raw, sport, geo, sports, company, as_of, key, target, policy, account, log)


def _ingest(raw, sport, geo, sports, company, as_of, key, target, policy, account, log) -> dict[str, str]:
    spark, names = raw.sparkSession, ["last_name", "first_name"]
    hr_path, sport_path = new_path(spark, "hr"), new_path(spark, "sport")
    statuses = {}
    with log.step("hr") as step:
        sealed = step.counts(encrypt(transform_hr(raw, geo, company, as_of, policy), names, key))
        step.status, _ = publish(
            sealed, hr_suite(), hr_path, reveal=lambda df: decrypt(df, names, key), violations_path=f"{account}/hr")
        statuses["hr"] = step.status
    with log.step("sport") as step:
        step.status, _ = publish(
            step.counts(sport), sport_suite(sports), sport_path, violations_path=f"{account}/sport")
        statuses["sport"] = step.status
    spark.read.parquet(f"{account}/hr").filter("drops_row").write.mode("overwrite").parquet(f"{account}/dropped")
    if FAILED in statuses.values():
        return statuses
    hr, declared = spark.read.parquet(hr_path), spark.read.parquet(sport_path)
    with log.step("merge") as step:
        merged = write_stage(step.counts(merge_hr_sport(hr, declared)), name="merged")
        audited = write_stage(raw.select("id"), name="audited")
        orphan_sports(declared, audited).write.mode("overwrite").parquet(f"{account}/orphans")
        step.status = statuses["merge"] = status_of(reconcile(hr, declared, merged, audited))
    if statuses["merge"] == FAILED:
        return statuses
    with log.step("load") as step:
        kms = {c: F.col(c).cast("decimal(10,1)") for c in ("distance_kms", "margin_kms")}
        loaded = merged.withColumns(kms).select(*EMPLOYEE_COLUMNS)
        if not first_load(spark, target):
            stored = write_stage(table_scan(spark, target, ["id"]), name="stored")
            again = loaded.join(stored.distinct(), "id", "left_semi").select("id")
            again = write_stage(again, f"{account}/known")
            loaded = loaded.join(stored, "id", "left_anti").select(*EMPLOYEE_COLUMNS)
            if not again.isEmpty():
                step.status = statuses["load"] = WARNING
                step.message = "employees that were there already are not loaded again"
        table_append(step.counts(loaded), target)
    return statuses


def first_load(spark: SparkSession, target: str | dict) -> bool:
    """Whether the employees table is missing or has no row."""
    if isinstance(target, str) and path_missing(spark, target):
        return True
    return is_empty(table_scan(spark, target))


def overall(statuses: dict[str, str]) -> str:
    for status in (FAILED, WARNING):
        if status in statuses.values():
            return status
    return SUCCESS
