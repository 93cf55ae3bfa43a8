"""Plans and hot keys: what has to hold on far larger data."""

import re

import pytest
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.operators.cdc import cdc_events, latest_state, latest_state_with_deletes
from activity_lake.operators.comments import parse_answers
from activity_lake.operators.diff import (
    apply_changes, diff_labels, fingerprint, mark_duplicates, snapshot_diff,
)
from activity_lake.operators.quality import (
    Between, DistinctInSet, NotNull, Unique, bad_values, run_suite, samples, settle, violations,
)
from activity_lake.operators.places import flatten_places
from activity_lake.operators.reporting import social_year_stats
from activity_lake.operators.shaping import dedupe, enrich_names, exists_in, orphans, share, with_batch
from activity_lake.sources.tables import write_stage
from activity_lake.streaming.gold import activities_gold, employees_gold
from activity_lake.streaming.outbox import clean_comments
from checks.views import KEY
from tests.helpers import plan, rows


def exchanges(df):
    return len(re.findall(r"Exchange (hash|range|Single|RoundRobin)", plan(df)))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one key, another third are copies of one row."""
    return write_stage(spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 'copy' else cast(id as string) end as id",
        "case when id % 3 = 1 then 0 else cast(id as int) end as v",
        "cast(case when id % 3 = 1 then 0 else id end as string) as fingerprint", "id as ts_ms"))


def test_decoding_and_business_columns_do_not_shuffle(views):
    for gold in (activities_gold(views.cdc_activities), employees_gold(views.cdc_employees, KEY)):
        text = plan(gold)
        assert "Exchange" not in text and "PythonUDF" not in text and "ArrowEval" not in text


def test_json_is_parsed_once(spark):
    raw = spark.range(5).selectExpr("cast(id as string) as value")
    parsed = [
        activities_gold(raw), latest_state_with_deletes(cdc_events(raw, schemas.ACTIVITY_EVENT)),
        flatten_places(raw, "value"), parse_answers(raw, "value")[0], parse_answers(raw, "value")[1],
    ]
    for df in parsed:
        assert plan(df).count("from_json") == 1, plan(df)
    assert plan(clean_comments(raw.selectExpr("value as id", "value as comment"), KEY)).count("aesDecrypt") == 1


def test_latest_state_limits_each_task_before_the_shuffle(spark, hot):
    text = plan(latest_state(hot))
    assert exchanges(latest_state(hot)) == 1
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert rows(latest_state(hot).filter("id in ('hot', 'copy')"), "id", "ts_ms") == [("copy", 29998), ("hot", 29997)]
    text = plan(dedupe(hot, "id", ["ts_ms"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_keys_are_combined_before_the_shuffle(spark, hot, no_broadcast):
    text = plan(diff_labels(hot, hot, unique=True))
    assert exchanges(diff_labels(hot, hot, unique=True)) == 2
    assert set(re.findall(r"ReadSchema: (\S+)", text)) == {"struct<id:string,fingerprint:string>"}
    unique = Unique("id", "")
    assert exchanges(unique.count(hot)) == 2 and "partial_sum" in plan(unique.count(hot))
    gold = hot.selectExpr("id as employee_id", "'y' as social_year", "v as distance_meters", "v as duration_sec")
    assert exchanges(social_year_stats(gold)) == 1 and "partial_sum" in plan(social_year_stats(gold))


def test_small_difference_does_not_shuffle_the_snapshots(spark, hot):
    unique = hot.filter("id not in ('hot', 'copy')").drop("ts_ms")
    stored = write_stage(unique.withColumn("comment", F.lit("c")).select("id", "v", "comment", "fingerprint"))
    incoming = write_stage(unique.filter("v > 100"))
    labels = write_stage(diff_labels(incoming, stored, unique=True))
    diff = snapshot_diff(incoming, stored, labels=labels)
    assert exchanges(diff) == 0 and "BroadcastHashJoin" in plan(diff)
    actions = write_stage(diff)
    assert actions.count() == unique.filter("v <= 100").count()
    # Only the actions are shuffled, the target is not.
    result = apply_changes(stored, actions)
    target = plan(result).split("Union")[1].split("BroadcastExchange")[0]
    assert "Exchange hash" not in target
    assert result.count() == incoming.count()


def test_no_full_outer_join_or_cartesian_product(views):
    from checks.registry import QUERIES
    from checks import columns, diffs, envelope, joins, quality, reports  # noqa: F401

    for name in ("snapshot_diff", "apply_changes", "merge_indicator", "bonus_what_if", "merge_reconcile", "employee_sheet"):
        text = plan(QUERIES[name](views.spark, views.sf_dir))
        assert "FullOuter" not in text and "CartesianProduct" not in text, name


def test_shuffles_of_a_report_do_not_grow_with_the_suite(spark, hot):
    known = write_stage(hot.select("id").distinct().filter("id <> 'hot'"))
    by_value = [Unique("id", ""), DistinctInSet("id", "", known=known), Unique("v", ""), Unique("fingerprint", "")]
    for times in (1, 3):
        suite = [*by_value, NotNull("id", ""), Between("v", "", high=10)] * times
        assert exchanges(bad_values(hot, list(enumerate(suite[:4] * times)))) == 1
        report = run_suite(hot, suite)
        # One more looked up the bad values: three in all.
        assert exchanges(report) == 2 and exchanges(run_suite(hot, settle(hot, suite), with_sample=False)) == 1
        assert [r["broken"] for r in report.orderBy("position").collect()] == [20_000, 10_000, 10_001, 10_001, 0, 19_993] * times


def test_hot_keys_give_whole_results(spark, hot, no_broadcast):
    assert mark_duplicates(hot).groupBy("duplicated").count().orderBy("duplicated").collect() == [(False, 10_000), (True, 20_000)]
    report = run_suite(hot, [Unique("id", ""), NotNull("id", ""), Between("v", "", high=10)])
    assert [r["broken"] for r in report.orderBy("position").collect()][:2] == [20_000, 0]
    assert samples(violations(hot, [Unique("id", "")])).first()["sample"].count(";") == 19
    shares = share(hot.withColumn("w", F.lit(1)), "id", "w").agg(F.round(F.sum("share"), 6)).first()[0]
    assert shares == hot.select("id").distinct().count()
    keys = hot.filter("id <> 'hot'").select("id").distinct()
    assert exists_in(hot, keys, "id").count() == 20_000
    empty = hot.filter("false").withColumn("comment", F.lit("c")).select("id", "v", "comment", "fingerprint")
    diff = snapshot_diff(hot.drop("ts_ms"), empty)
    assert diff.groupBy("status").count().orderBy("status").collect() == [("modified", 20_000), ("new", 10_000)]


def test_an_oversized_side_is_split(spark, hot, no_broadcast):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for name, size in small.items():
        spark.conf.set(name, size)
    try:
        known = hot.select("id").distinct()
        named = write_stage(known.selectExpr("id", "'a' as first_name", "'b' as last_name"))
        joins = [
            mark_duplicates(hot), Unique("id", "").violating(hot), Unique("id", "").satisfying(hot),
            share(hot.withColumn("w", F.lit(1)), "id", "w"), orphans(hot, known.filter("id = 'hot'"), "id"),
            enrich_names(hot.withColumnRenamed("id", "employee_id"), named),
        ]
        for df in joins:
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            assert "skew=true" in plan(df)
    finally:
        for name in small:
            spark.conf.unset(name)


def test_scans_read_only_what_is_needed(views):
    from checks.registry import QUERIES
    from checks import reports  # noqa: F401

    text = plan(QUERIES["count_rows"](views.spark, views.sf_dir))
    assert "ReadSchema: struct<l_returnflag:string>" in text
    scan = plan(views.table("orders").filter("o_orderkey = 5").select("o_custkey"))
    assert "EqualTo(o_orderkey,5)" in scan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in scan


def test_numbering_batches_does_not_shuffle(spark, hot):
    text = plan(with_batch(hot))
    assert "Exchange hash" not in text and "Window" not in text and "BroadcastHashJoin" in text


def test_fingerprint_is_native(views):
    text = plan(fingerprint(views.activities, schemas.FINGERPRINT_COLUMNS))
    assert "Exchange" not in text and "Python" not in text
