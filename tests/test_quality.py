"""Rules, cleaning, publishing, reconciliation."""

import os

from activity_lake.operators.quality import (
    FAILED, SUCCESS, WARNING, Between, ByValue, DistinctInSet, InSet, NotNull, Unique, clean, keep_valid, orphan_sports,
    publish, quarantine, reconcile, run_suite, status_of, suite_status,
)
from activity_lake.operators.reporting import alerts, observed, rollup
from activity_lake.plans.suites import activity_suite, hr_suite, sport_suite
from tests.helpers import rows


def people(spark):
    return spark.createDataFrame(
        [("1", "a", 10), ("2", None, 20), ("3", "b", None), ("4", "c", 99), (None, "d", 5), ("5", "a", -1)],
        "id string, name string, n int")


def counts(df, *rules):
    return [r["broken"] for r in run_suite(df, list(rules)).orderBy("position").collect()]


def test_rules(spark):
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "known string")
    assert counts(
        people(spark), NotNull("name", ""), InSet("name", "", values=("a", "b")), Between("n", "", low=0, high=90),
        Between("n", "", low=5, strict_low=True), Between("n", "", high=20), Unique("name", ""),
        DistinctInSet("name", "", known=known, known_column="known"),
    ) == [1, 2, 2, 2, 1, 2, 2]


def test_violating_and_satisfying_split_the_rows(spark):
    known = spark.createDataFrame([("a",), (None,)], "known string")
    df = people(spark)
    for rule in (NotNull("name", ""), InSet("name", "", values=("a",)), Between("n", "", low=0, high=90),
                 Unique("name", ""), DistinctInSet("name", "", known=known, known_column="known")):
        bad, good = rule.violating(df), rule.satisfying(df)
        assert rows(bad.unionByName(good)) == rows(df), rule
        assert bad.count() == rule.count(df).first()["broken"], rule
        if isinstance(rule, ByValue):
            assert rows(rule.settled(df).violating(df)) == rows(bad)


def test_status_levels(spark):
    df = people(spark)
    warn, fail = NotNull("name", "", WARNING), NotNull("id", "", FAILED)
    fine = Between("n", "", FAILED, low=-5)
    assert status_of(run_suite(df, [fine])) == SUCCESS
    assert status_of(run_suite(df, [fine, warn])) == WARNING
    assert status_of(run_suite(df, [fine, warn, fail])) == FAILED
    assert suite_status(run_suite(df, [warn])).columns == ["status"]


def test_all_dropping_rules_apply_together(spark):
    suite = [NotNull("id", "", WARNING, keep_row=False), NotNull("name", "", WARNING, keep_row=False),
             Between("n", "", WARNING, keep_row=False, low=0), NotNull("n", "", WARNING)]
    assert rows(clean(people(spark), suite)) == [("1", "a", 10), ("3", "b", None), ("4", "c", 99)]
    dropped = quarantine(people(spark), suite)
    assert rows(dropped, "position", "reference", "value") == [(1, None, None), (2, "2", None), (3, "5", "-1")]


def test_failed_suite_publishes_nothing_but_keeps_columns(spark):
    cleaned = clean(people(spark), [NotNull("id", "", FAILED)])
    assert cleaned.count() == 0 and cleaned.columns == ["id", "name", "n"]


def test_more_broken_rows_than_the_sample_are_all_dropped(spark):
    df = spark.range(500).selectExpr("cast(id as string) as id", "if(id % 2 = 0, null, 'x') as name")
    suite = [NotNull("name", "", WARNING, keep_row=False)]
    report = run_suite(df, suite).first()
    assert report["broken"] == 250 and len(report["sample"].split("; ")) == 20
    assert keep_valid(df, suite).count() == 250
    assert quarantine(df, suite).count() == 250


def test_publish(spark, tmp_path):
    df, good, bad = people(spark), str(tmp_path / "good"), str(tmp_path / "bad")
    status, report = publish(df, [NotNull("id", "", WARNING, keep_row=False), Unique("id", "")], good)
    assert status == WARNING and report.count() == 2 and spark.read.parquet(good).count() == 5
    status, _ = publish(df, [Unique("name", "", FAILED)], bad)
    assert status == FAILED and not os.path.exists(bad)


def test_suites_have_their_rules(spark):
    known = spark.createDataFrame([("1",)], "id string")
    sports = spark.createDataFrame([("run", 1)], "sport string, strava_list int")
    assert [len(s) for s in (hr_suite(), sport_suite(sports), activity_suite(known))] == [11, 3, 6]
    dropping = [r.column for r in hr_suite() if not r.keep_row]
    assert dropping == ["id", "distance_kms", "margin_kms", "salary"]


def test_reconcile(spark):
    hr = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    sport = spark.createDataFrame([("1", "run"), ("8", None), ("9", "ski")], "id string, sport_type string")
    merged = hr.join(sport, "id", "left").filter("id <> '3'")
    report = reconcile(hr, sport, merged)
    assert rows(report, "position", "found", "result") == [
        (1, 1, FAILED), (2, 1, WARNING), (3, 2, WARNING), (4, 1, FAILED)]
    assert rows(orphan_sports(sport, merged)) == [("9", "ski")]


def test_rollup_and_alerts(spark):
    steps = spark.createDataFrame(
        [("a", SUCCESS), ("a", WARNING), ("b", SUCCESS), ("c", WARNING), ("c", FAILED)], "run string, status string")
    assert rows(rollup(steps)) == [("a", WARNING), ("b", SUCCESS), ("c", FAILED)]
    assert rows(alerts(rollup(steps)), "run") == [("a",), ("c",)]


def test_rows_are_counted_while_written(spark, tmp_path):
    df, seen = observed(people(spark), "people")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 6}
