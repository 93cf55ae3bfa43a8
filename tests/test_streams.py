"""Totals, notifications, joins and paid calls under late, repeated and broken deliveries."""

import json
import os

import pytest
from activity_lake.functions.privacy import encrypt
from activity_lake.operators.comments import score_once
from activity_lake.operators.versions import BucketTable
from activity_lake.sources.change_log import cdc_source
from activity_lake.sources.commits import BatchStore
from activity_lake.sources.tables import write_stage
from activity_lake.streaming.gold import enriched, start_enriched
from activity_lake.streaming.outbox import start_outbox
from activity_lake.streaming.totals import compact_totals, current_totals, start_totals
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.helpers import rows
from tests.test_plans import KEY

JULY, DAY = 1_719_800_000_000_000, 86_400_000_000


def row(id, employee="e", meters=10, seconds=60, begin=JULY):
    return {"id": id, "employee_id": employee, "sport": "run", "begin_date": begin, "duration_sec": seconds,
            "distance_meters": meters}


def change(op, lsn, before, after, ts=1):
    return json.dumps({"payload": {"op": op, "ts_ms": ts, "source": {"lsn": lsn}, "before": before, "after": after}})


def send(tmp_path, part, *messages):
    folder = tmp_path / "topic"
    os.makedirs(folder, exist_ok=True)
    (folder / f"{part}.txt").write_text("\n".join(messages))
    return str(folder)


def totals(spark, tmp_path, part, *messages, **more):
    folder, path = send(tmp_path, part, *messages), str(tmp_path / "totals")
    start_totals(cdc_source(spark, folder), path, str(tmp_path / "c"), once=True, **more).awaitTermination()
    return rows(current_totals(spark, path))


def test_totals_follow_moves_and_deletes_in_any_order(spark, tmp_path):
    a, b, none = row("a"), row("b", meters=None), row("n", meters=None, employee="f")
    assert totals(spark, tmp_path, "one", change("c", 1, None, a), change("c", 2, None, b), change("r", 3, None, none)) == [
        ("e", "2024-2025", 2, 10, 120), ("f", "2024-2025", 1, None, 60)]
    moved = row("a", begin=JULY - 300 * DAY, meters=7)
    # The delete of the moved row arrives before its move.
    assert totals(spark, tmp_path, "two", change("d", 9, moved, None)) == [
        ("e", "2023-2024", -1, -7, -60), ("e", "2024-2025", 2, 10, 120), ("f", "2024-2025", 1, None, 60)][1:]
    assert compact_totals(spark, str(tmp_path / "totals")) == 1
    assert totals(spark, tmp_path, "three", change("u", 8, a, moved), change("u", 10, b, row("b", "g"))) == [
        ("f", "2024-2025", 1, None, 60), ("g", "2024-2025", 1, 10, 60)]


def test_totals_need_whole_old_rows(spark, tmp_path):
    with pytest.raises(StreamingQueryException, match="no old row is logged for a"):
        totals(spark, tmp_path, "one", change("u", 1, {"id": "a"}, row("a")))


def test_redelivered_events_count_once(spark, tmp_path):
    first = change("c", 1, None, row("a"), ts=1000)
    assert totals(spark, tmp_path, "one", first, first, within="1 hour") == [("e", "2024-2025", 1, 10, 60)]
    again = totals(spark, tmp_path, "two", first, change("c", 2, None, row("b"), ts=2000), within="1 hour")
    assert again == [("e", "2024-2025", 2, 20, 120)]


def test_redelivered_messages_are_sent_once(spark, tmp_path):
    people = spark.createDataFrame([("a", "Bravo"), ("b", "")], "id string, comment string")
    sealed = {r["id"]: r["comment"] for r in encrypt(people, ["comment"], KEY).collect()}

    def run(part, *events):
        folder = send(tmp_path, part, *[change("c", n, None, {"id": i, "comment": sealed[i]}, ts=n) for i, n in events])
        start_outbox(cdc_source(spark, folder), KEY, "SLACK", str(tmp_path / "outbox"), str(tmp_path / "c"), once=True,
                     within="1 hour").awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "outbox")), "id", "text")

    assert run("one", ("a", 1), ("a", 1), ("b", 2)) == [("a", "Bravo")]
    assert run("two", ("a", 1), ("a", 3)) == [("a", "Bravo")] * 2


def test_an_employee_added_in_between_is_found(spark, tmp_path):
    people = spark.createDataFrame([("1", "HR")], "person string, unit string").withColumn("fingerprint", F.md5("unit"))
    table = BucketTable.create(people, str(tmp_path / "people"), key="person", buckets=4)
    schema = T.StructType.fromDDL("id string, unit string")

    def run(part, *ids):
        folder = send(tmp_path, part, *ids)
        stream = cdc_source(spark, folder).select(F.col("value").alias("id"), F.col("value").alias("person"))
        start_enriched(stream, lambda: table.read().select("person", "unit"), "person", str(tmp_path / "out"),
                       str(tmp_path / "c"), once=True).awaitTermination()
        return rows(enriched(spark, str(tmp_path / "out"), schema))

    assert run("one", "1", "2") == [("1", "HR"), ("2", None)]
    hired = spark.createDataFrame([("1", "HR"), ("3", "IT")], "person string, unit string").withColumn("fingerprint", F.md5("unit"))
    table.apply(write_stage(table.diff(hired)))
    assert run("two", "3") == [("1", "HR"), ("2", None), ("3", "IT")]


def test_no_prompt_is_paid_for_twice(spark, tmp_path):
    calls, ledger = str(tmp_path / "calls"), str(tmp_path / "ledger")
    os.mkdir(calls)
    prompts = spark.createDataFrame([(i, 1, f"prompt {i}") for i in range(12)], "batch int, rows long, prompt string")

    def writer(prompt):
        import os
        import uuid

        if prompt == "prompt 9" and not os.path.exists(f"{calls}/mended"):
            os._exit(3)  # the worker is lost in the middle of the job
        open(f"{calls}/{prompt}~{uuid.uuid4().hex}", "w").close()
        return f"answer to {prompt}"

    with pytest.raises(Exception):
        score_once(prompts.coalesce(1).sort("batch"), {"w": writer}, ledger)
    before = len(os.listdir(calls))
    open(f"{calls}/mended", "w").close()
    scored = rows(score_once(prompts, {"w": writer}, ledger), "batch", "answer", "writer")
    assert scored == sorted(((i, f"answer to prompt {i}", "w") for i in range(12)), key=repr)
    asked = [f.split("~")[0] for f in os.listdir(calls) if "~" in f]
    # Only tasks that were running when the job failed may have been lost with their answer.
    assert set(asked) == {f"prompt {i}" for i in range(12)} and len(asked) - 12 < 8 and before > 0
    again = score_once(prompts, {"w": lambda p: 1 / 0}, ledger)
    assert rows(again, "batch", "answer", "writer") == scored
    assert len([f for f in os.listdir(calls) if "~" in f]) == len(asked)


def test_sealed_answers_only(spark, tmp_path):
    prompts = spark.createDataFrame([(1, 1, "to Ana")], "batch int, rows long, prompt string")
    score_once(prompts, {"w": lambda p: "Ana runs"}, str(tmp_path / "ledger"), seal=lambda df: encrypt(df, ["answer"], KEY))
    written = spark.read.parquet(str(tmp_path / "ledger")).first()
    assert "Ana" not in str(tuple(written)) and written["writer"] == "w"


def test_a_store_of_another_kind_is_refused(spark, tmp_path):
    BatchStore(spark, str(tmp_path / "totals")).claim("something else")
    with pytest.raises(ValueError, match="holds something else"):
        totals(spark, tmp_path, "one", change("c", 1, None, row("a")))
