"""Nothing is lost, doubled or shown: state, jobs, comments, stages."""

import glob
import json
import os

import pytest
from activity_lake import schemas
from activity_lake.functions.privacy import decrypted, encrypt
from activity_lake.operators.cdc import latest_state, latest_state_with_deletes
from activity_lake.operators.diff import diff_labels, fingerprint, snapshot_diff
from activity_lake.operators.quality import SUCCESS, WARNING, NotNull, Unique, publish, quarantine, reconcile
from activity_lake.operators.shaping import merge_indicator, with_batch
from activity_lake.plans.activities import comment_actions
from activity_lake.session import shared_dir
from activity_lake.sources.change_log import cdc_source, kafka_options
from activity_lake.sources.tables import job_stages, path_missing, typed_scan, write_stage
from activity_lake.streaming.state import compact, current_state, prune, record_changes, start_upsert
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.helpers import rows
from tests.test_plans import KEY, activity_sheet, hr_sheet, ingest
from tests.test_scale import exchanges

ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("sport", T.StringType())])


def event(op, ts_ms, lsn, id, sport=None):
    gone = op == "d"
    return json.dumps({"payload": {
        "op": op, "ts_ms": ts_ms, "source": {"lsn": lsn}, "before": {"id": id} if gone else None,
        "after": None if gone else {"id": id, "sport": sport}}})


def feed(spark, tmp_path, part, *messages):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("topic", "state", "checkpoint"))
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{part}.txt", "w") as out:
        out.write("\n".join(messages))
    start_upsert(cdc_source(spark, folder), ROW, path, checkpoint, once=True).awaitTermination()
    return path


def test_compacting_again_keeps_the_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert current_state(spark, path, ROW).count() == 0 and compact(spark, path, ROW) == -1
    feed(spark, tmp_path, "one", *[event("c", 1, i, str(i), "run") for i in range(500)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert compact(spark, path, ROW) == compact(spark, path, ROW) == 0
        assert current_state(spark, path, ROW).count() == 500
        assert len(os.listdir(f"{path}/snapshots")) == 1
        feed(spark, tmp_path, "two", event("d", 2, 900, "3"))
        assert compact(spark, path, ROW) == compact(spark, path, ROW) == 1
        assert current_state(spark, path, ROW).count() == 499
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert prune(spark, path) == 0
    assert prune(spark, path, keep_hours=0) == 3
    assert current_state(spark, path, ROW).count() == 499


def test_changes_of_one_millisecond_follow_the_log(spark, tmp_path):
    messages = [m for i in range(40) for m in (
        event("c", 5, 10 * i, f"u{i}", "old"), event("u", 5, 10 * i + 1, f"u{i}", "new"),
        event("c", 5, 10 * i + 2, f"d{i}", "old"), event("d", 5, 10 * i + 3, f"d{i}"))]
    path = feed(spark, tmp_path, "one", *messages)
    assert rows(current_state(spark, path, ROW)) == sorted((f"u{i}", "new") for i in range(40))
    events = spark.createDataFrame(
        [("a", "c", 1, 2), ("a", "d", 1, 10), ("b", "d", 1, 9), ("b", "c", 1, 11)], "id string, op string, ts_ms long, lsn long")
    assert rows(latest_state(events), "id", "op") == [("a", "d"), ("b", "c")]
    assert rows(latest_state_with_deletes(events), "id") == [("b",)]


def test_recorded_changes_leave_other_folders_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = T.StructType([*ROW.fields, T.StructField("fingerprint", T.StringType())])

    def table(*data):
        return fingerprint(spark.createDataFrame(list(data), ROW), ["id", "sport"])

    def step(run, incoming):
        stored = current_state(spark, path, schema)
        labels = write_stage(diff_labels(incoming, stored, unique=True))
        record_changes(write_stage(snapshot_diff(incoming, stored, labels=labels)), schema, path, run)

    step(1, table(*[(str(i), "run") for i in range(200)]))
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/changes/1-*/*")}
    step(2, table(*[(str(i), "ski" if i == 7 else "run") for i in range(1, 200)], ("new", "run")))
    assert before == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/changes/1-*/*")}
    assert spark.read.parquet(*glob.glob(f"{path}/changes/2-*")).count() == 3
    assert rows(current_state(spark, path, ROW)) == sorted(
        [(str(i), "ski" if i == 7 else "run") for i in range(1, 200)] + [("new", "run")])


def test_all_violations_are_written(spark, tmp_path):
    df = spark.range(300).select(F.when(F.col("id") < 250, F.lit(None)).otherwise(F.col("id")).alias("id"))
    found = str(tmp_path / "found")
    status, report = publish(
        df, [NotNull("id", "given", WARNING, keep_row=False)], str(tmp_path / "ok"), violations_path=found, sample_size=3)
    assert status == WARNING and report.first()["broken"] == 250 and report.first()["sample"].count(";") == 2
    listed = spark.read.parquet(found)
    assert listed.count() == 250 and rows(listed.select("severity", "drops_row").distinct()) == [(WARNING, True)]


def test_quarantine_evaluates_dropping_rules_only(spark, monkeypatch):
    monkeypatch.setattr(Unique, "bad", lambda *_: pytest.fail("a keeping rule was looked up"))
    df = spark.createDataFrame([(1, None), (1, 2)], "id long, v long")
    assert rows(quarantine(df, [Unique("id", "u"), NotNull("v", "n", WARNING, keep_row=False)]), "reference") == [("1",)]
    assert quarantine(df, [Unique("id", "u")]).count() == 0


def writer_for(fail=(), omit=()):
    def write(prompt):
        asked = [r["id"] for r in json.loads(prompt[prompt.index("[{", prompt.index("Activities:")):])]
        if set(asked) & set(fail):
            raise RuntimeError("down")
        return json.dumps({"results": [{"id": i, "comment": f"fine {i}"} for i in asked if i not in omit]})

    return write


def test_no_comment_is_lost(spark, tmp_path):
    people = encrypt(hr_sheet(spark, "1"), ["first_name", "last_name"], KEY)
    actions = fingerprint(activity_sheet(spark, *[(f"a{i:03}", i) for i in range(250)])).selectExpr(
        "*", "cast(null as string) as comment", "'left_only' as _merge", "'new' as status")
    for fail, omit in (((), ()), (("a100",), ("a007",)), ([f"a{i:03}" for i in range(250)], ())):
        rejects = str(tmp_path / f"rejects{len(fail)}")
        done = comment_actions(actions.coalesce(1), people, KEY, {"w": writer_for(fail, omit)}, rejects_path=rejects)
        texts = {r["id"]: r["c"] for r in done.select("id", decrypted("comment", KEY).alias("c")).collect()}
        missing = {r["id"] for r in spark.read.parquet(rejects).collect()}
        assert len(texts) == 250 and all(texts.values())
        assert missing == {i for i, c in texts.items() if not c.startswith("fine")}
        assert set(omit) <= missing and (len(fail) == 250) == (len(missing) == 250)


def test_several_tasks_answer(spark, tmp_path):
    people = encrypt(hr_sheet(spark, "1"), ["first_name", "last_name"], KEY)
    actions = fingerprint(activity_sheet(spark, *[(f"a{i}", i) for i in range(2000)])).selectExpr(
        "*", "cast(null as string) as comment", "'left_only' as _merge", "'new' as status")
    folder = str(tmp_path / "tasks")
    os.makedirs(folder)

    def write(prompt):
        from pyspark import TaskContext

        open(f"{folder}/{TaskContext.get().partitionId()}", "w").close()
        return writer_for()(prompt)

    assert comment_actions(actions, people, KEY, {"w": write}, parallel=4).count() == 2000
    assert len(os.listdir(folder)) > 1


def test_dropped_employees_are_no_orphans_and_loads_do_not_double(spark, tmp_path):
    target = str(tmp_path / "employees")
    sheet = hr_sheet(spark, "1", "2").unionByName(hr_sheet(spark, "3", salary=5))
    sport = spark.createDataFrame([("1", "run"), ("2", "run"), ("3", "run")], schemas.SPORT_SHEET)
    statuses = ingest(spark, sheet, sport, target)
    assert statuses == {"hr": WARNING, "sport": SUCCESS, "merge": SUCCESS}
    statuses = ingest(spark, sheet.unionByName(hr_sheet(spark, "4")), sport, target)
    assert statuses["load"] == WARNING
    assert rows(spark.read.parquet(target), "id") == [("1",), ("2",), ("4",)]


def test_reconcile_takes_one_shuffle_by_id(spark):
    hr = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    sport = spark.createDataFrame([("1", "run"), ("8", None), ("9", "run"), (None, "run")], schemas.SPORT_SHEET)
    merged = spark.createDataFrame([("1", "run"), ("2", None), (None, None)], "id string, sport_type string")
    report = reconcile(hr, sport, merged)
    assert rows(report, "position", "found") == [(1, 0), (2, 2), (3, 3), (4, 2)]
    assert rows(reconcile(hr, sport, merged, hr.unionByName(spark.createDataFrame([("9",)], "id string"))), "found") == [
        (0,), (1,), (2,), (2,)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # By id, and the partial sums to one row.
        assert exchanges(report) == 2
        left = spark.createDataFrame([(1, "a", "l"), (2, None, "l"), (None, "n", "l")], "id long, v string, w string")
        right = spark.createDataFrame([(2, "b", "r"), (3, "c", "r"), (None, "m", "r")], "id long, v string, x string")
        once = merge_indicator(left, right, ["id"], unique=True)
        assert exchanges(once) == 2
        assert rows(once) == rows(merge_indicator(left, right, ["id"]))
        assert rows(merge_indicator(left, right, ["id"], "left", unique=True)) == rows(
            merge_indicator(left, right, ["id"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fast_fingerprints_see_moved_values(spark):
    df = spark.createDataFrame(
        [("a", None, 60), ("b", 60, None), ("c", None, None), ("d", 60, 60), ("e", 0, None)], "id string, x int, y int")
    marks = [r["fingerprint"] for r in fingerprint(df, ["x", "y"], "xxhash64").collect()]
    assert len(set(marks)) == 5


def test_broken_sheet_rows_are_rejected(spark, tmp_path):
    path = str(tmp_path / "sheet.csv")
    with open(path, "w") as out:
        out.write('Any,Header\n1,"a\nb"\n2,c\n')
    sheet = typed_scan(spark, path, schemas.SPORT_SHEET, reject_column="line").cache()
    assert rows(sheet.filter("line is null"), "id", "sport_type") == [("1", "a"), ("2", "c")]
    assert rows(sheet.filter("line is not null"), "line") == [('b"',)]
    assert rows(typed_scan(spark, path, schemas.SPORT_SHEET, multi_line=True)) == [("1", "a\nb"), ("2", "c")]


def test_batches_follow_the_numbers_of_files(spark, monkeypatch):
    monkeypatch.setattr("activity_lake.operators.shaping.PARTS_PER_BLOCK", 2)
    df = spark.range(1000).select(F.format_string("%04d", "id").alias("id"))
    got = with_batch(df.repartition(6), 100, order=("id",))
    assert rows(got.select("id", (F.col("batch") == F.floor(F.col("id").cast("int") / 100)).alias("right")).filter("not right")) == []
    assert rows(with_batch(df.repartition(7), 100).groupBy("batch").count(), "count") == [(100,)] * 10


def test_stages_of_a_job_are_removed(spark):
    with job_stages(spark):
        write_stage(spark.range(3), name="owned")
        owned = glob.glob(f"{shared_dir(spark)}/activity_lake/owned-*")
        assert len(owned) == 1
    assert path_missing(spark, owned[0])


def test_first_micro_batch_of_a_topic_is_bounded():
    options = kafka_options("t", "b:1", min_partitions=64)
    assert options["maxOffsetsPerTrigger"].isdigit() and options["minPartitions"] == "64"
    assert options["failOnDataLoss"] == "true" and "minPartitions" not in kafka_options("t", "b:1")


