"""Batches, prompts and pluggable writers."""

import json

from pyspark.sql import functions as F

from activity_lake.operators import comments
from activity_lake.operators.comments import (
    INSTRUCTIONS, build_prompts, comment_context, default_comments, parse_answers, score_batches, token_records,
)
from activity_lake.operators.places import flatten_places
from activity_lake.operators.reporting import token_report
from activity_lake.operators.shaping import attach_comments, normalize_sport, share, with_batch
from tests.helpers import rows


def test_batches_are_full(spark):
    # Repeated keys do not matter, nor how many files the rows are in.
    df = spark.range(0, 1234, 1, 7).selectExpr("cast(id % 3 as string) as id", "id as n")
    for order in ((), ("id",), ("n",)):
        batches = with_batch(df, order=order)
        sizes = [r["count"] for r in batches.groupBy("batch").count().orderBy("batch").collect()]
        assert sizes == [100] * 12 + [34] and batches.select("n").distinct().count() == 1234
    assert batches.filter("batch <> n div 100").isEmpty()


def test_context_and_default_comments(spark):
    actions = spark.createDataFrame(
        [("a", "1", "run", "", 1250, 3660, "left_only"), ("b", "9", "ski", "snow", None, 60, "left_only"),
         ("c", "1", "run", "old", 1, 1, "right_only")],
        "id string, employee_id string, sport string, situation string, distance_meters int, duration_sec int, _merge string")
    people = spark.createDataFrame([("1", "Ana", "Blanc")], "id string, first_name string, last_name string")
    context = comment_context(actions, people)
    assert rows(context) == [("a", "Ana B.", "run", "", "1.2 km en 1h01"), ("b", None, "ski", "snow", "1 min")]
    assert rows(default_comments(context)) == [("a", "Bypass IA : No comment"), ("b", "Bypass IA : snow")]


def test_old_images_keep_their_comment(spark):
    actions = spark.createDataFrame(
        [("a", "left_only", None), ("a", "right_only", "old"), ("b", "left_only", "kept?")],
        "id string, _merge string, comment string")
    comments = spark.createDataFrame([("a", "new"), ("a", "second")], "id string, comment string")
    assert rows(attach_comments(actions, comments)) == [
        ("a", "left_only", "new"), ("a", "right_only", "old"), ("b", "left_only", None)]


def test_a_failing_writer_does_not_fail_the_job(spark):
    df = spark.range(250).selectExpr("cast(id as string) as id", "'x' as name")
    prompts = build_prompts(df, ["id", "name"])
    skip = len(INSTRUCTIONS)

    def picky(prompt):
        import json

        rows = json.loads(prompt[skip:])
        if len(rows) < 100:
            raise ValueError("short batch")
        return json.dumps({"results": [{"id": r["id"], "comment": "ok"} for r in rows]})

    scored = score_batches(prompts, {"picky": picky}).cache()
    comments, rejects = parse_answers(scored)
    assert comments.count() == 200 and comments.select("id").distinct().count() == 200
    lost = rejects.collect()
    assert [(r["rows"], r["writer"], r["error"]) for r in lost] == [(50, None, "picky: short batch")]
    assert scored.filter("answer is not null and llm_tokens > 0 and context_tokens > 0").count() == 2

    def spare(prompt):
        return "not json"

    scored = score_batches(prompts, {"picky": picky, "spare": spare}, parallel=3)
    assert rows(scored.groupBy("writer").count()) == [("picky", 2), ("spare", 1)]
    assert token_records(scored).filter("context_tokens > 0 and operation = 'search'").count() == 3
    assert parse_answers(scored)[1].count() == 1


def test_normalize_sport(spark):
    sports = spark.createDataFrame(
        [(1, "Course à pied", "running, jogging"), (2, "Vélo", "bike,jogging,BMX"), (3, "velo", None)],
        "position long, sport string, alias string")
    raw = ["Running", "JOGGING", "bmx", "course-a/pied", " VÉLO ", "", None, "judo"]
    df = spark.createDataFrame([(r,) for r in raw], "sport_type string").coalesce(1)
    assert dict(normalize_sport(df, sports).collect()) == {
        "Running": "Course à pied", "JOGGING": "Vélo", "bmx": None, "course-a/pied": "Course à pied",
        " VÉLO ": "Vélo", "": None, None: None, "judo": None,
    }


def test_share_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 2)], "g string, w int")
    assert rows(share(df, "g", "w")) == [("a", 1, 0.25), ("a", 3, 0.75), (None, 2, 1.0)]


def test_token_report(spark):
    log = spark.createDataFrame(
        [("s", "t1", "vectorization", None, 4, 10), ("s", "t2", "chat", 7, None, None), ("s", "t3", "search", 8, None, None),
         ("e", "t9", "other", 5, 1, 1)],
        "session_id string, timestamp string, operation string, total_tokens long, chunks long, tokens long")
    report = {r["session_id"]: r.asDict() for r in token_report(log).collect()}
    assert report["s"] == {
        "session_id": "s", "session_start": "t1", "session_end": "t3", "vectorizations": 1, "chunks": 4,
        "vector_tokens": 10, "avg_tokens_per_chunk": 2.5, "searches": 2, "search_tokens": 15,
        "avg_tokens_per_search": 7.5, "total_tokens": 25}
    assert (report["e"]["avg_tokens_per_chunk"], report["e"]["total_tokens"]) == (0.0, 0)


def test_flatten_places(spark):
    document = json.dumps({"elements": [
        {"lat": 1.0, "lon": 2.0, "tags": {"name": "a", "addr:city": "", "is_in:city": "c", "natural": "peak"}},
        {"lat": 0.0, "center": {"lat": 3.0, "lon": 4.0}, "tags": {"name": "b", "leisure": "park", "natural": "x"}},
        {"lat": 1.0, "lon": 2.0, "tags": {"sport": "ski"}}, {"lat": 1.0, "tags": {"name": ""}}, {"lat": 1.0},
    ]})
    docs = spark.createDataFrame([(document,), ("broken",), (None,)], "document string")
    assert rows(flatten_places(docs)) == [
        ("a", "c", "peak", 1.0, 2.0), ("b", "Hérault", "park", 3.0, 4.0)]


def test_prompts_are_in_id_order(spark):
    df = spark.createDataFrame([("b", "é"), ("a", None)], "id string, name string")
    prompt = build_prompts(df, ["id", "name"]).select(F.col("prompt")).first()["prompt"]
    assert json.loads(prompt[len(INSTRUCTIONS):]) == [{"id": "a", "name": None}, {"id": "b", "name": "é"}]


def test_a_ledger_is_read_once_for_what_was_answered(spark, tmp_path, monkeypatch):
    prompts = spark.createDataFrame([(i, 1, f"prompt {i}") for i in range(6)], "batch long, rows long, prompt string")
    ledger, read = str(tmp_path / "ledger"), spark.sparkContext.accumulator(0)
    assert comments.score_once(prompts, {"w": str.upper}, ledger, per_task=2).filter("answer like 'PROMPT%'").count() == 6

    def counted(*args):
        def run(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        known = read_or_empty(*args)
        return known.mapInArrow(run, known.schema)

    read_or_empty = comments.read_or_empty
    monkeypatch.setattr(comments, "read_or_empty", counted)
    assert comments.score_once(prompts, {}, ledger).filter("answer is not null").count() == 6
    assert read.value == 6
