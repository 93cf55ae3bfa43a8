"""Activity ingestion: a sheet to the next version of the activities table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.privacy import decrypt, encrypt, encrypt_new
from activity_lake.operators.comments import (
    BATCH_SIZE, build_prompts, comment_context, default_comments, parse_answers, score_batches, score_once, token_records,
)
from activity_lake.operators.diff import (
    apply_changes, change_audit, change_counts, diff_gate, diff_labels, diff_summary, fingerprint, snapshot_diff,
)
from activity_lake.operators.quality import FAILED, WARNING, publish
from activity_lake.operators.shaping import attach_comments, conform, with_batch
from activity_lake.operators.versions import BucketTable
from activity_lake.plans.runs import RunLog
from activity_lake.plans.suites import activity_suite
from activity_lake.session import new_path
from activity_lake.sources.tables import append_token_records, job_stages, write_stage


def comment_actions(
    actions: DataFrame,
    employees: DataFrame,
    key: str,
    writers: dict[str, Callable[[str], str]] | None = None,
    pause: float = 0.0,
    token_path: str | None = None,
    parallel: int | None = None,
    rejects_path: str | None = None,
    instructions: str | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Write comments for the new images and encrypt them.

    Batches are numbered before names are added, and answers are staged
    encrypted and without their prompts: no stage names people. ``token_path``
    gets a token record per answered batch. ``parallel`` tasks call the
    writers, as many as the cluster has cores if it is not given. A new image
    whose batch failed, could not be read or left its id out gets the default
    comment; ``rejects_path`` lists these ids with the writers' errors. With a
    ``ledger`` a repeated run does not ask again what was answered.
    """
    spark = actions.sparkSession
    plain = decrypt(employees.select("id", "first_name", "last_name"), ["first_name", "last_name"], key)
    if writers:
        fresh = with_batch(actions.filter(F.col("_merge") == "left_only"), BATCH_SIZE)
        fresh = write_stage(fresh, name="numbered")
        prompts = build_prompts(comment_context(fresh, plain), instructions=instructions)
        if ledger:
            answers = write_stage(score_once(
                prompts, writers, ledger, pause, seal=lambda df: encrypt(df, ["answer"], key)), name="answers")
        else:
            parallel = parallel or spark.sparkContext.defaultParallelism
            scored = score_batches(prompts, writers, pause, parallel).drop("prompt")
            answers = write_stage(encrypt(scored, ["answer"], key), name="answers")
        if token_path:
            append_token_records(token_records(answers), token_path)
        comments, _ = parse_answers(decrypt(answers, ["answer"], key))
        comments = comments.filter(F.col("comment").isNotNull())
        left_out = fresh.join(comments.select("id").distinct(), "id", "left_anti")
        if rejects_path:
            left_out.select("id", "batch").join(answers.select("batch", "error"), "batch", "left") \
                .write.mode("overwrite").parquet(rejects_path)
        comments = comments.unionByName(default_comments(comment_context(left_out, plain)))
    else:
        comments = default_comments(comment_context(actions, plain))
    return encrypt_new(attach_comments(actions, comments), "comment", key)


def ingest_activities(
    sheet: DataFrame,
    stored: DataFrame | BucketTable,
    employees: DataFrame,
    key: str,
    target: str | None = None,
    writers: dict[str, Callable[[str], str]] | None = None,
    token_path: str | None = None,
    parallel: int | None = None,
    account: str | None = None,
    log: RunLog | None = None,
    ledger: str | None = None,
) -> dict[str, str]:
    """Audit, compare, comment and carry out the changes.

    A ``stored`` table in buckets gets its next version: equal buckets are not
    read, untouched ones not written. Otherwise the whole new table goes to
    ``target``, which must not be the folder ``stored`` is read from. Returns the
    step statuses and whether the flow went on; with writers also whether they
    wrote all comments. A load that changes or deletes what was stored is a
    WARNING. Every step leaves a row in the run table of ``log``, by default in
    ``account``. ``account`` is a folder for what the run did: all
    ``violations``, the ``audit`` of old and new values, the ``counts`` per kind
    of change, and the ``rejects`` of the writers. Stages are removed at the end.
    """
    spark = sheet.sparkSession
    account = account or new_path(spark, "activities-account")
    log = log or RunLog(spark, f"{account}/runs", "ingest_activities")
    with job_stages(spark):
        return _ingest(sheet, stored, employees, key, target, writers, token_path, parallel, account, log, ledger)


def _ingest(sheet, stored, employees, key, target, writers, token_path, parallel, account, log, ledger) -> dict[str, str]:
    spark = sheet.sparkSession
    valid_path = new_path(spark, "activities")
    with log.step("validate") as step:
        step.status, _ = publish(
            fingerprint(step.counts(conform(sheet, schemas.ACTIVITY_SHEET))), activity_suite(employees), valid_path,
            violations_path=f"{account}/violations")
        statuses = {"validate": step.status}
    if statuses["validate"] == FAILED:
        return {**statuses, "continue": "NO"}
    with log.step("scan") as step:
        incoming = spark.read.parquet(valid_path)
        # The suite has just checked the incoming ids; stored ones are keys.
        if isinstance(stored, BucketTable):
            found = stored.diff(incoming)
        else:
            stored = stored.select(*schemas.STORED_COLUMNS)
            labels = write_stage(diff_labels(incoming, stored, unique=True), name="labels")
            found = snapshot_diff(incoming, stored, labels=labels)
        actions = write_stage(step.counts(found), name="actions")
        gate = diff_gate(diff_summary(actions, incoming)).first()
        step.status = gate["status"]
        statuses |= {"scan": gate["status"], "continue": gate["continue"]}
    if gate["continue"] == "NO":
        return statuses
    with log.step("comments") as step:
        rejects = f"{account}/rejects"
        commented = write_stage(step.counts(comment_actions(
            actions, employees, key, writers, token_path=token_path, parallel=parallel, rejects_path=rejects,
            ledger=ledger)),
            name="commented")
        if writers and not spark.read.parquet(rejects).isEmpty():
            step.status = WARNING
        if writers:
            statuses["comments"] = step.status
    with log.step("load") as step:
        change_counts(commented).write.mode("overwrite").parquet(f"{account}/counts")
        change_audit(actions, schemas.FINGERPRINT_COLUMNS).write.mode("overwrite").parquet(f"{account}/audit")
        if isinstance(stored, BucketTable):
            stored.apply(commented)
        else:
            apply_changes(stored, commented).write.mode("overwrite").parquet(target)
        # At most one row per kind of change.
        changed = {r["status"]: r["rows"] for r in spark.read.parquet(f"{account}/counts").collect()}
        step.status = statuses["load"] = gate["status"]
        step.message = ", ".join(f"{n} {kind}" for kind, n in sorted(changed.items()))
    return statuses
