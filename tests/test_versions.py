"""State and tables whose readers, writers and compaction run beside each other."""

import glob
import os

import pytest
from activity_lake.operators.diff import diff_labels, fingerprint, snapshot_diff
from activity_lake.operators.versions import BucketTable
from activity_lake.sources.commits import BatchStore, put_file
from activity_lake.sources.tables import write_stage
from activity_lake.streaming.state import compact, current_state, prune, record_changes, start_upsert
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.helpers import rows
from tests.test_safety import ROW, event, feed


def half_committed(path):
    """Take a batch back to the moment in which one of its files is in place: no marker, a file aside."""
    marker = glob.glob(f"{path}/commits/1-*")[0]
    folder = f"{path}/changes/{os.path.basename(marker)}"
    files = sorted(glob.glob(f"{folder}/part-*.parquet"))
    assert len(files) > 1
    aside = f"{path}/aside.parquet"
    os.rename(files[-1], aside)
    os.rename(marker, f"{path}/marker")
    return lambda: (os.rename(aside, files[-1]), os.rename(f"{path}/marker", marker))


def test_half_a_batch_is_neither_shown_nor_covered(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = feed(spark, tmp_path, "one", *[event("c", 1, i, str(i), "run") for i in range(10)])
        feed(spark, tmp_path, "two", *[event("c", 2, i, str(i), "run") for i in range(10, 30)])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    finish = half_committed(path)
    assert current_state(spark, path, ROW).count() == 10
    assert compact(spark, path, ROW) == 0 and prune(spark, path, keep_hours=0) == 1
    finish()
    assert current_state(spark, path, ROW).count() == 30
    assert compact(spark, path, ROW) == 1 and prune(spark, path, keep_hours=0) == 2
    assert current_state(spark, path, ROW).count() == 30


def test_nothing_behind_a_gap_is_covered(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "store"))
    store.claim("numbers")
    for n in range(3):
        assert store.add(spark.range(n + 1), n) and not store.add(spark.range(9), n)
    gap = glob.glob(f"{store.path}/commits/1-*")[0]
    os.rename(gap, f"{store.path}/gap")
    df, last = store.read(T.StructType([T.StructField("id", T.LongType())]))
    assert df.count() == 1 and last == 0
    with pytest.raises(ValueError):
        store.add(spark.range(1), 2)
    os.rename(f"{store.path}/gap", gap)
    assert store.read(df.schema)[0].count() == 6


def test_kinds_of_state_are_told_apart(spark, tmp_path):
    path = feed(spark, tmp_path, "one", event("c", 1, 1, "a", "run"))
    actions = spark.createDataFrame([("b", "ski", "left_only", "new")], "id string, sport string, _merge string, status string")
    with pytest.raises(ValueError, match="holds events"):
        record_changes(actions, ROW, path, 5)
    runs = str(tmp_path / "runs")
    assert record_changes(actions, ROW, runs, 5) and not record_changes(actions, ROW, runs, 5)
    with pytest.raises(ValueError, match="does not follow"):
        record_changes(actions, ROW, runs, 7)
    with pytest.raises(ValueError, match="holds numbered runs"):
        start_upsert(spark.readStream.format("rate").load(), ROW, runs, str(tmp_path / "other"))
    assert rows(current_state(spark, runs, ROW)) == [("b", "ski")]


def test_small_files_appear_once_and_whole(spark, tmp_path):
    put_file(spark, str(tmp_path / "log" / "1"), "é")
    assert os.listdir(tmp_path / "log") == ["1", ".1.crc"] or "1" in os.listdir(tmp_path / "log")
    with pytest.raises(FileExistsError):
        put_file(spark, str(tmp_path / "log" / "1"), "other")
    assert open(tmp_path / "log" / "1").read() == "é"


SCHEMA = "id string, sport string, place int"


def snapshot(spark, changed=(), gone=(), new=()):
    data = [(str(i), "ski" if i in changed else "run", i) for i in range(2000) if i not in gone]
    return fingerprint(spark.createDataFrame([*data, *[(k, "new", 0) for k in new]], SCHEMA), ["sport", "place"])


def files(path):
    return {f: (os.stat(f).st_mtime_ns, open(f, "rb").read()) for f in glob.glob(f"{path}/data/*/*/*.parquet")}


def bucket_of(f):
    return int(f.split("key_bucket=")[1].split("/")[0])


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "table")
    table = BucketTable.create(snapshot(spark), path, buckets=32)
    before = files(path)
    incoming = snapshot(spark, changed=(7,), gone=(9,), new=("x",))
    where = {r[0] for r in spark.createDataFrame([("7",), ("9",), ("x",)], "id string").select(table.bucket()).collect()}
    assert table.differing(incoming) == where
    left, right = table.compare(incoming)
    assert {bucket_of(f) for f in right.inputFiles()} == where
    actions = write_stage(table.diff(incoming))
    whole = write_stage(diff_labels(incoming, table.read(), unique=True))
    assert rows(actions) == rows(snapshot_diff(incoming, table.read(), labels=whole))
    assert table.apply(actions) == 1
    after = files(path)
    assert {f: after[f] for f in before} == before
    assert {bucket_of(f) for f in after.keys() - before.keys()} == where
    assert rows(table.read()) == rows(incoming) and rows(table.read(0)) == rows(snapshot(spark))
    again = BucketTable.open_table(spark, path)
    assert again == table and again.differing(incoming) == set() and again.diff(incoming).count() == 0
    assert again.apply(again.diff(incoming)) == 1


def test_emptied_buckets_and_pruning(spark, tmp_path):
    table = BucketTable.create(snapshot(spark), str(tmp_path / "table"), buckets=4)
    only = snapshot(spark, gone=set(range(2000)), new=("x",))
    assert table.apply(write_stage(table.diff(only))) == 1 and len(table.manifest()) == 1
    assert rows(table.read()) == rows(only)
    assert table.prune(keep=2) == 0 and table.prune(keep=1) == 4
    assert rows(table.read()) == rows(only) and table.read(0).count() == 0


def test_a_writer_that_was_overtaken_is_refused(spark, tmp_path, monkeypatch):
    table = BucketTable.create(snapshot(spark), str(tmp_path / "table"), buckets=4)
    put_file(spark, f"{table.path}/versions/1", "")
    monkeypatch.setattr(BucketTable, "version", lambda self: 0)
    with pytest.raises(FileExistsError):
        table.commit(snapshot(spark), {0, 1, 2, 3})


def test_empty_tables_and_null_marks(spark, tmp_path):
    empty = snapshot(spark).filter("false")
    table = BucketTable.create(empty, str(tmp_path / "table"), buckets=4)
    assert table.read().count() == 0 and table.differing(empty) == set()
    some = snapshot(spark, gone=set(range(3, 2000))).withColumn("fingerprint", F.when(F.col("id") != "1", F.col("fingerprint")))
    table.apply(write_stage(table.diff(some)))
    assert rows(table.read()) == rows(some) and table.differing(some) == set()
    assert table.diff(empty).filter("status = 'deleted'").count() == 3
