"""Snapshot comparison and upserts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from activity_lake.operators.diff import (
    apply_changes, change_counts, diff_gate, diff_labels, diff_summary, fingerprint, mark_duplicates, snapshot_diff,
)
from activity_lake.operators.shaping import merge_indicator, sort_by_indicator
from activity_lake.sources.tables import write_stage
from tests.helpers import rows

SCHEMA = "id string, v int, comment string, fingerprint string"


def frame(spark, pairs, comment=None):
    return spark.createDataFrame([(i, f, comment, str(f)) for i, f in pairs], SCHEMA)


def golden(spark):
    left = frame(spark, [("1", 1), ("2", 2), ("3", 3), ("4", 4)]).drop("comment")
    right = frame(spark, [("1", 1), ("2", 3), ("3", 3), ("5", 5)], "old")
    return left, right


def test_golden_case(spark):
    left, right = golden(spark)
    assert rows(snapshot_diff(left, right), "id", "fingerprint", "_merge", "status", "comment") == [
        ("2", "2", "left_only", "modified", None), ("2", "3", "right_only", "modified", "old"),
        ("4", "4", "left_only", "new", None), ("5", "5", "right_only", "deleted", "old"),
    ]
    summary = diff_summary(snapshot_diff(left, right), left)
    assert summary.first().asDict() == {
        "incoming": 4, "identical": 2, "new": 1, "deleted": 1, "modified": 1}
    assert tuple(diff_gate(summary).first()) == ("YES", "WARNING")
    assert rows(change_counts(snapshot_diff(left, right))) == [("deleted", 1), ("modified", 1), ("new", 1)]


def test_written_labels_give_the_same_diff(spark):
    left, right = golden(spark)
    for unique in (False, True):
        labels = write_stage(diff_labels(left, right, unique=unique))
        assert rows(snapshot_diff(left, right, labels=labels)) == rows(snapshot_diff(left, right))


def test_merge_indicator(spark):
    left, right = golden(spark)
    merged = merge_indicator(left, right, ["id", "fingerprint"])
    assert rows(merged, "id", "fingerprint", "v", "comment", "_merge") == [
        ("1", "1", 1, "old", "both"), ("2", "2", 2, None, "left_only"), ("2", "3", 3, "old", "right_only"),
        ("3", "3", 3, "old", "both"), ("4", "4", 4, None, "left_only"), ("5", "5", 5, "old", "right_only")]
    order = [r["_merge"] for r in sort_by_indicator(merged).collect()]
    assert order == sorted(order, key=["left_only", "right_only", "both"].index)
    assert merge_indicator(left, right, ["id", "fingerprint"], "left").count() == 4


def test_only_new_rows_give_success(spark):
    left, right = frame(spark, [("1", 1), ("2", 2)]).drop("comment"), frame(spark, [("1", 1)])
    summary = diff_summary(snapshot_diff(left, right), left)
    assert tuple(diff_gate(summary).first()) == ("YES", "SUCCESS")
    same = diff_summary(snapshot_diff(right.drop("comment"), right), right)
    assert tuple(diff_gate(same).first()) == ("NO", "SUCCESS")


def test_repeated_ids_are_modified(spark):
    # Two images of one id on the incoming side, nothing stored.
    left, right = frame(spark, [("1", 1), ("1", 2), ("2", 1), ("2", 1)]).drop("comment"), frame(spark, [])
    assert rows(snapshot_diff(left, right), "id", "fingerprint", "status") == [
        ("1", "1", "modified"), ("1", "2", "modified"), ("2", "1", "modified"), ("2", "1", "modified")]


def test_null_ids_are_left_out(spark):
    left = frame(spark, [(None, 1), ("1", 1)]).drop("comment")
    assert rows(snapshot_diff(left, frame(spark, [(None, 2)])), "id", "status") == [("1", "new")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 3)),
       st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 3)))
def test_applying_the_diff_gives_the_incoming_snapshot(spark, new, old):
    left, right = frame(spark, new.items()).drop("comment"), frame(spark, old.items(), "c")
    result = write_stage(apply_changes(right, snapshot_diff(left, right)))
    assert rows(result, "id", "v") == sorted(new.items(), key=repr)
    assert snapshot_diff(left, result).isEmpty()
    cols = ("id", "fingerprint", "_merge", "status")
    assert rows(diff_labels(left, right), *cols) == rows(diff_labels(left, right, unique=True), *cols)


def test_mark_duplicates_keeps_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    assert rows(mark_duplicates(df)) == [("a", True), ("a", True), ("b", False), (None, True), (None, True)]


def test_fingerprint_keeps_values_apart(spark):
    df = spark.createDataFrame(
        [("a", "b|c", None), ("a|b", "c", None), ("a", None, "b|c"), ("", None, None), (None, "", None)],
        "x string, y string, z string")
    marks = [r["fingerprint"] for r in fingerprint(df, ["x", "y", "z"]).collect()]
    assert len(set(marks)) == 5
    fast = [r["fingerprint"] for r in fingerprint(df, ["x", "y", "z"], "xxhash64").collect()]
    assert all(f.lstrip("-").isdigit() for f in fast)
