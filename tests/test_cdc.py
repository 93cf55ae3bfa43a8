"""Envelopes, current state, streams."""

import json
import os

from activity_lake import schemas
from activity_lake.operators.cdc import cdc_events, cdc_rows, latest_state, latest_state_with_deletes
from activity_lake.functions.privacy import encrypted
from activity_lake.operators.shaping import stamp
from activity_lake.sources.change_log import cdc_source
from activity_lake.sources.tables import token_log, typed_scan
from activity_lake.streaming.gold import activities_gold, start_gold
from activity_lake.streaming.outbox import route, start_outbox
from activity_lake.streaming.state import compact, current_state, start_upsert
from pyspark.sql import functions as F
from tests.helpers import rows

KEY = "0123456789abcdef"
ROW = schemas.ACTIVITY_EVENT


def message(op, ts_ms, **after):
    gone = op == "d"
    return json.dumps({"payload": {
        "op": op, "ts_ms": ts_ms, "before": {"id": after["id"]} if gone else None, "after": None if gone else after}})


MESSAGES = [
    message("c", 1, id="a", employee_id="1", sport="run", begin_date=1704067798778549, duration_sec=60, distance_meters=5),
    message("c", 2, id="b", employee_id="1", sport="run", begin_date=1704067798778549, duration_sec=70),
    message("u", 3, id="a", employee_id="2", sport="ski", begin_date=1719900000000000, duration_sec=61, distance_meters=6),
    message("d", 4, id="b"), None, "garbage", '{"payload": 3}',
]


def raw(spark):
    return spark.createDataFrame([(m.encode() if m else None,) for m in MESSAGES], "value binary")


def test_only_upserts_remain(spark):
    assert rows(cdc_rows(raw(spark), ROW), "id", "sport", "duration_sec") == [
        ("a", "run", 60), ("a", "ski", 61), ("b", "run", 70)]


def test_events_keep_deletes(spark):
    events = cdc_events(raw(spark), ROW)
    assert rows(events, "id", "op", "ts_ms") == [("a", "c", 1), ("a", "u", 3), ("b", "c", 2), ("b", "d", 4)]
    assert rows(latest_state_with_deletes(events), "id", "sport") == [("a", "ski")]
    assert rows(latest_state(events.filter("op <> 'd'")), "id", "sport") == [("a", "ski"), ("b", "run")]


def test_gold_columns(spark):
    gold = activities_gold(raw(spark))
    assert rows(gold, "id", "social_year", "start_year") == [
        ("a", "2023-2024", 2023), ("a", "2024-2025", 2024), ("b", "2023-2024", 2023)]
    assert gold.filter("_event_timestamp is null").count() == 0


def lines(path, part):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{part}.txt", "w") as out:
        out.write("\n".join(m or "" for m in MESSAGES) + "\n")


def test_stream_equals_batch_and_a_second_run_adds_nothing(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("topic", "gold", "checkpoint"))
    lines(folder, "one")
    for _ in range(2):
        gold = activities_gold(cdc_source(spark, folder)).drop("_event_timestamp")
        start_gold(gold, path, checkpoint, partition_by=["start_year"], once=True).awaitTermination()
        batch = activities_gold(raw(spark)).drop("_event_timestamp")
        assert rows(spark.read.parquet(path).select(*batch.columns)) == rows(batch)


def test_replayed_batch_does_not_repeat_messages(spark, tmp_path):
    folder, path = str(tmp_path / "topic"), str(tmp_path / "outbox")
    sealed = spark.createDataFrame([("a", ' "hi" '), ("b", ""), ("c", None)], "id string, c string").select(
        F.to_json(F.struct(F.struct(F.struct("id", encrypted("c", KEY).alias("comment")).alias("after")).alias("payload"))))
    sealed.write.text(folder)
    # A fresh checkpoint makes the same batch run again.
    for checkpoint in ("one", "two"):
        start_outbox(cdc_source(spark, folder), KEY, "LOG", path, str(tmp_path / checkpoint), once=True).awaitTermination()
    outbox = spark.read.parquet(path)
    assert rows(route(outbox), "id", "target", "text", "route") == [("a", "LOG", "'hi'", "log")]


def test_target_none_writes_nothing(spark, tmp_path):
    folder, path = str(tmp_path / "topic"), str(tmp_path / "outbox")
    lines(folder, "one")
    start_outbox(cdc_source(spark, folder), KEY, "NONE", path, str(tmp_path / "c"), once=True).awaitTermination()
    assert not os.path.exists(path)


def test_upserted_state_survives_compaction_and_late_events(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("topic", "state", "checkpoint"))

    def run(part, *messages):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{part}.txt", "w") as out:
            out.write("\n".join(messages))
        start_upsert(cdc_source(spark, folder), ROW, path, checkpoint, once=True).awaitTermination()
        return rows(current_state(spark, path, ROW), "id", "sport")

    assert run("one", *[m for m in MESSAGES if m]) == [("a", "ski")]
    assert compact(spark, path, ROW) == 0
    assert rows(current_state(spark, path, ROW), "id", "sport") == [("a", "ski")]
    # An event older than the delete does not bring the row back.
    assert run("two", message("u", 3, id="b", sport="late"), message("c", 9, id="c", sport="swim")) == [
        ("a", "ski"), ("c", "swim")]
    assert compact(spark, path, ROW) == 1
    assert run("three", message("d", 10, id="a")) == [("c", "swim")]


def test_typed_scan_names_by_position(spark, tmp_path):
    path = str(tmp_path / "sheet.csv")
    with open(path, "w") as out:
        out.write('Any,Header\n1,"a, b"\n2,\n')
    assert rows(typed_scan(spark, path, schemas.SPORT_SHEET)) == [("1", "a, b"), ("2", None)]
    assert typed_scan(spark, path, schemas.SPORT_SHEET, max_rows=1).count() == 1


def test_token_log_takes_session_from_file_name(spark, tmp_path):
    with open(tmp_path / "tokens_s1.jsonl", "w") as out:
        out.write('{"operation": "chat", "total_tokens": 3}\n\n{"operation": "chat", "session_id": "own"}\n')
    assert rows(token_log(spark, str(tmp_path)), "session_id", "total_tokens") == [("own", None), ("s1", 3)]


def test_stamp(spark):
    assert stamp(spark.range(1)).filter("processed_at is not null").count() == 1
