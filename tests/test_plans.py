"""Whole ingestion jobs."""

import datetime as dt
import glob
import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.privacy import decrypt, decrypted
from activity_lake.operators.diff import fingerprint
from activity_lake.plans.activities import ingest_activities
from activity_lake.plans.hr import EMPLOYEE_COLUMNS, ingest_hr, overall, transform_hr
from activity_lake.sources.tables import token_log
from tests.helpers import rows

KEY = "0123456789abcdef"
PERSON = ("2000-01-01", "HR", "2020-01-01", 30000, "CDI", 25, "home", "Marche/running")


def hr_sheet(spark, *ids, **changes):
    from decimal import Decimal

    base = dict(zip(schemas.HR_SHEET.fieldNames(), ["", "Blanc", "Ana", *PERSON])) | changes
    data = [tuple((base | {"id": i, "salary": Decimal(base["salary"])})[n] for n in schemas.HR_SHEET.fieldNames()) for i in ids]
    return spark.createDataFrame(data, schemas.HR_SHEET)


def hr_inputs(spark):
    geo = spark.createDataFrame([("home", 0.0, 0.1)], "address string, lat double, lon double")
    sports = spark.createDataFrame([(1, "run", None, "a|b", 1)], schemas.SPORT_DIMENSION)
    return geo, sports


def ingest(spark, sheet, sport, target, **more):
    geo, sports = hr_inputs(spark)
    return ingest_hr(sheet, sport, geo, sports, (0.0, 0.0), "2026-01-01", KEY, target, **more)


def test_transform_hr(spark):
    geo, _ = hr_inputs(spark)
    row = transform_hr(hr_sheet(spark, "1"), geo, (0.0, 0.0), "2026-01-01").first().asDict()
    assert (row["distance_kms"], row["margin_kms"], row["age"], row["seniority_years"]) == (11.13, 15 - 11.13, 26, 6)
    assert not {"birthday", "entry_date", "address"} & set(row)


def test_ingest_hr(spark, tmp_path):
    target = str(tmp_path / "employees")
    sport = spark.createDataFrame([("1", "run"), ("2", "chess")], schemas.SPORT_SHEET)
    sheet = hr_sheet(spark, "1", "2").unionByName(hr_sheet(spark, "3", salary=5))
    statuses = ingest(spark, sheet, sport, target)
    # The poorly paid row is dropped before the merge, so nobody counts as lost.
    assert statuses == {"hr": "WARNING", "sport": "WARNING", "merge": "SUCCESS"} and overall(statuses) == "WARNING"
    loaded = spark.read.parquet(target)
    assert loaded.columns == EMPLOYEE_COLUMNS
    plain = decrypt(loaded, ["first_name", "last_name"], KEY)
    assert rows(plain, "id", "first_name", "last_name", "sport_type") == [
        ("1", "Ana", "Blanc", "run"), ("2", "Ana", "Blanc", "chess")]
    assert loaded.filter("first_name = 'Ana'").count() == 0


def test_nothing_written_names_people(spark, tmp_path, monkeypatch):
    shared = str(tmp_path / "shared")
    monkeypatch.setattr("activity_lake.session.shared_dir", lambda _: shared)
    monkeypatch.setattr("activity_lake.sources.tables.remove_path", lambda *_: None)
    sport = spark.createDataFrame([("1", "run")], schemas.SPORT_SHEET)
    ingest(spark, hr_sheet(spark, "1"), sport, str(tmp_path / "employees"))
    # Rows that break every rule of the suite, the failing ones included.
    broken = [
        hr_sheet(spark, "2", "2"), hr_sheet(spark, "3", transport_mode="Inconnu", employement_contract="x"),
        hr_sheet(spark, "4", salary=5, birthday="2020-01-01", entry_date="1990-01-01"),
        hr_sheet(spark, "5", address="nowhere"), hr_sheet(spark, None),
    ]
    assert ingest(spark, reduce(DataFrame.unionByName, broken), sport, str(tmp_path / "more"))["hr"] == "FAILED"
    files = glob.glob(f"{shared}/activity_lake/**/*.parquet", recursive=True)
    stages = {os.path.dirname(f) for f in files}
    assert len(stages) > 10
    for stage in stages:
        for row in spark.read.parquet(stage).collect():
            assert "Blanc" not in str(tuple(row)) and "home" not in str(tuple(row)), stage


def test_failed_hr_is_not_loaded(spark, tmp_path):
    target = tmp_path / "employees"
    sport = spark.createDataFrame([("1", "run")], schemas.SPORT_SHEET)
    assert ingest(spark, hr_sheet(spark, "1", "1"), sport, str(target))["hr"] == "FAILED"
    extra = spark.createDataFrame([("1", "run"), ("9", "run")], schemas.SPORT_SHEET)
    assert ingest(spark, hr_sheet(spark, "1"), extra, str(target))["merge"] == "FAILED"
    assert not target.exists()


def activity_sheet(spark, *acts):
    day = dt.datetime(2024, 7, 1, 10)
    data = [("1", "run", "", meters, day, 60, i) for i, meters in acts]
    return spark.createDataFrame(data, schemas.ACTIVITY_SHEET)


def test_ingest_activities(spark, tmp_path):
    sheet = hr_sheet(spark, "1")
    from activity_lake.functions.privacy import encrypt

    people = encrypt(sheet, ["first_name", "last_name"], KEY)
    empty = fingerprint(activity_sheet(spark)).selectExpr(
        *[c if c != "comment" else "cast(null as string) as comment" for c in schemas.STORED_COLUMNS])
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    statuses = ingest_activities(activity_sheet(spark, ("a", 1), ("b", 2), ("c", 3)), empty, people, KEY, first)
    assert statuses == {"validate": "SUCCESS", "scan": "SUCCESS", "continue": "YES", "load": "SUCCESS"}
    stored = spark.read.parquet(first)

    again = ingest_activities(activity_sheet(spark, ("a", 1), ("b", 2), ("c", 3)), stored, people, KEY, second)
    assert again["continue"] == "NO"

    statuses = ingest_activities(activity_sheet(spark, ("a", 1), ("b", 9), ("d", 4)), stored, people, KEY, second)
    assert statuses == {"validate": "SUCCESS", "scan": "WARNING", "continue": "YES", "load": "WARNING"}
    result = spark.read.parquet(second)
    assert result.columns == schemas.STORED_COLUMNS
    clear = result.withColumn("comment", decrypted("comment", KEY))
    assert rows(clear, "id", "distance_meters", "comment") == [
        ("a", 1, "Bypass IA : No comment"), ("b", 9, "Bypass IA : No comment"), ("d", 4, "Bypass IA : No comment")]
    # The untouched row still carries the very same cipher text.
    assert rows(result.filter("id = 'a'"), "comment") == rows(stored.filter("id = 'a'"), "comment")


def test_valid_activities_are_written_once(spark, tmp_path, monkeypatch):
    from activity_lake.plans import activities

    stages, write = [], activities.write_stage
    monkeypatch.setattr(activities, "write_stage", lambda df, path=None, name="stage": stages.append(name) or write(df, path, name))
    target = str(tmp_path / "v1")
    stored = fingerprint(activity_sheet(spark)).selectExpr(
        *[c if c != "comment" else "cast(null as string) as comment" for c in schemas.STORED_COLUMNS])
    ingest_activities(activity_sheet(spark, ("a", 1), ("b", 2)), stored, hr_sheet(spark, "1"), KEY, target)
    assert "fingerprinted" not in stages
    marks = fingerprint(activity_sheet(spark, ("a", 1), ("b", 2)))
    assert rows(spark.read.parquet(target), "id", "fingerprint") == rows(marks, "id", "fingerprint")


def test_repeated_activity_ids_stop_the_flow(spark, tmp_path):
    statuses = ingest_activities(
        activity_sheet(spark, ("a", 1), ("a", 2)), fingerprint(activity_sheet(spark)), hr_sheet(spark, "1"), KEY,
        str(tmp_path / "v"))
    assert statuses == {"validate": "FAILED", "continue": "NO"}


def test_writers_are_used(spark, tmp_path):
    from activity_lake.plans.activities import comment_actions
    from activity_lake.functions.privacy import encrypt

    actions = fingerprint(activity_sheet(spark, ("a", 1))).selectExpr(
        "*", "cast(null as string) as comment", "'left_only' as _merge", "'new' as status")
    people = encrypt(hr_sheet(spark, "1"), ["first_name", "last_name"], KEY)

    def writer(prompt):
        import json
        import re

        row = json.loads(re.search(r"\[\{.*", prompt, re.S).group(0).split("Activities:\n")[-1])[0]
        return json.dumps({"results": [{"id": row["id"], "comment": row["name"] + " " + row["performance"]}]})

    tokens = str(tmp_path / "tokens")
    commented = comment_actions(actions, people, KEY, {"w": writer}, token_path=tokens)
    assert token_log(spark, tokens).filter("total_tokens = context_tokens + llm_tokens").count() == 1
    assert commented.select(decrypted("comment", KEY)).first()[0] == "Ana B. 0.0 km en 1 min"


def test_steps_are_recorded_whatever_becomes_of_them(spark, tmp_path):
    from activity_lake.plans.runs import RunLog, run_table

    path = str(tmp_path / "runs")
    assert run_table(spark, path).count() == 0
    log = RunLog(spark, path, "flow", "first")
    with log.step("count") as step:
        step.counts(spark.range(7).withColumn("b", F.lit(1))).write.parquet(str(tmp_path / "out"))
    with pytest.raises(ValueError), log.step("break"):
        raise ValueError("no such sheet")
    got = run_table(spark, path).orderBy("place").collect()
    assert [(r["step"], r["status"], r["rows"], r["columns"], r["message"]) for r in got] == [
        ("count", "SUCCESS", 7, 2, None), ("break", "FAILED", None, None, "ValueError: no such sheet")]
    assert all(r["started"] <= r["ended"] for r in got)


def test_jobs_record_their_steps(spark, tmp_path):
    from activity_lake.operators.reporting import alerts, rollup
    from activity_lake.plans.runs import run_table

    account = str(tmp_path / "account")
    sport = spark.createDataFrame([("1", "run"), ("9", "run")], schemas.SPORT_SHEET)
    ingest(spark, hr_sheet(spark, "1"), sport, str(tmp_path / "employees"), account=account)
    steps = run_table(spark, f"{account}/runs")
    assert rows(steps, "step", "status", "rows") == [
        ("hr", "SUCCESS", 1), ("merge", "FAILED", 1), ("sport", "SUCCESS", 2)]
    assert rows(alerts(rollup(steps)), "status") == [("FAILED",)]
