"""Comments written in batches by a pluggable writer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake import schemas
from activity_lake.functions.text import (
    answer_tokens, default_comment, display_name, format_performance, parse_answer, prompt_tokens,
)
from activity_lake.operators.shaping import enrich_names, with_batch
from activity_lake.sources.tables import read_or_empty, write_stage

# Fixed value: rows per batch.
BATCH_SIZE = 100

INSTRUCTIONS = (
    "You congratulate employees on their sport activities. For each activity below write one warm "
    "paragraph of 200 to 250 characters that greets the person by name, remarks on sport, distance "
    "and duration, takes up the situation if one is given, and closes on an encouraging note.\n"
    'Answer with JSON only: {"results": [{"id": "<id as given>", "comment": "<text>"}]}\n'
    "Activities:\n"
)


def comment_context(actions: DataFrame, employees: DataFrame) -> DataFrame:
    """What a writer gets to see of each new image; names are plain text here.

    A batch number given to the actions is kept.
    """
    fresh = enrich_names(actions.filter(F.col("_merge") == "left_only"), employees)
    kept = [c for c in ("batch",) if c in actions.columns]
    return fresh.withColumns({
        "name": display_name("first_name", "last_name"),
        "performance": format_performance("distance_meters", "duration_sec"),
    }).select(*schemas.COMMENT_CONTEXT, *kept)


def default_comments(context: DataFrame) -> DataFrame:
    """Comments without a model, as ``id, comment``."""
    return context.select("id", default_comment("situation").alias("comment"))


def build_prompts(
    df: DataFrame, cols: list[str] | None = None, size: int = BATCH_SIZE, instructions: str | None = None
) -> DataFrame:
    """One prompt per batch: instructions and the batch as a JSON list.

    Rows without a ``batch`` are numbered first. A batch has at most ``size``
    rows, which bounds the collected list.
    """
    row = F.struct(*(cols or schemas.COMMENT_CONTEXT))
    instructions = INSTRUCTIONS if instructions is None else instructions
    numbered = df if "batch" in df.columns else with_batch(df, size)
    gathered = numbered.groupBy("batch").agg(
        F.count("*").alias("rows"),
        F.to_json(F.sort_array(F.collect_list(row)), {"ignoreNullFields": "false"}).alias("context"),
    )
    return gathered.select(
        "batch", "rows", F.concat(F.lit(instructions), F.col("context")).alias("prompt"))


def score_batches(
    prompts: DataFrame,
    writers: dict[str, Callable[[str], str]],
    pause: float = 0.0,
    parallel: int | None = None,
) -> DataFrame:
    """Answer each prompt with the first writer that does not fail.

    A task calls its writers one prompt at a time; ``parallel`` spreads the
    prompts over that many tasks, which their small size alone would not do.
    A failing batch gets a null answer and its errors; the job goes on. Write
    the result as a stage before using it, so that a lost executor does not
    repeat calls already paid for.
    """
    def answer_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for frame in frames:
            answers, used, errors = [], [], []
            for prompt in frame["prompt"]:
                answer, writer, failed = None, None, []
                for name, write in writers.items():
                    try:
                        answer, writer = write(prompt), name
                        break
                    except Exception as error:  # a writer may fail in any way
                        failed.append(f"{name}: {error}")
                answers.append(answer)
                used.append(writer)
                errors.append("; ".join(failed) or None)
                if pause:
                    time.sleep(pause)
            yield frame.assign(answer=answers, writer=used, error=errors)

    if parallel:
        # Without a key: a shuffle by batch would be taken for the one below it, and coalesced.
        prompts = prompts.repartition(parallel)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema)
    scored = prompts.mapInPandas(answer_all, f"{names}, answer string, writer string, error string")
    return scored.withColumns({
        "context_tokens": prompt_tokens("prompt"), "llm_tokens": answer_tokens("answer"),
    })


LEDGER = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("answer", T.StringType()), T.StructField("writer", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("context_tokens", T.LongType()), T.StructField("llm_tokens", T.LongType()),
])


def score_once(
    prompts: DataFrame,
    writers: dict[str, Callable[[str], str]],
    ledger: str,
    pause: float = 0.0,
    per_task: int = 1,
    seal: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``score_batches`` with a ledger of answered prompts, so that no rerun repeats a call already paid for.

    A prompt is known by its digest. Answers are appended to the ledger as
    their task ends: what is lost with an executor, or with the job, are the
    calls of tasks that had not ended, ``per_task`` prompts each. Failed prompts
    are noted with their errors and asked again by the next run. ``seal``
    encrypts the answers before they are written; prompts never are.
    """
    spark = prompts.sparkSession
    keyed = write_stage(prompts.select("batch", "rows", F.sha2("prompt", 256).alias("digest")), name="digests")
    # The ledger has a file per task; it is read once for both uses below.
    answered = write_stage(
        read_or_empty(spark, ledger, LEDGER).filter("answer is not null").select("digest").distinct(), name="answered")
    todo = prompts.withColumn("digest", F.sha2("prompt", 256)).join(
        answered, "digest", "left_anti").dropDuplicates(["digest"])
    tasks = max(1, -(-keyed.join(answered, "digest", "left_anti").count() // per_task))
    scored = seal(score_batches(todo, writers, pause, tasks).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER]))
    # With this way of committing, files of ended tasks stay where a job fails.
    scored.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
    best = F.max_by(F.struct(*[c for c in LEDGER.fieldNames() if c != "digest"]), F.col("answer").isNotNull())
    known = spark.read.schema(LEDGER).parquet(ledger).groupBy("digest").agg(best.alias("b")).select("digest", "b.*")
    return keyed.join(write_stage(known, name="ledger"), "digest", "left").drop("digest")


def token_records(scored: DataFrame, operation: str = "search") -> DataFrame:
    """Token record of each answered batch; the time of the record names its session."""
    now = F.current_timestamp()
    return scored.filter(F.col("writer").isNotNull()).select(
        F.date_format(now, "yyyyMMdd_HHmmss").alias("session_id"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(operation).alias("operation"), F.lit(0).cast("long").alias("query_tokens"),
        "context_tokens", "llm_tokens",
    )


def parse_answers(df: DataFrame, answer: str = "answer") -> tuple[DataFrame, DataFrame]:
    """Comments as ``id, comment``, and the rows whose answer cannot be read."""
    # A list of one keeps the parsed answer from being computed again in filters.
    parsed = df.select("*", F.explode(F.array(parse_answer(answer))).alias("_parsed"))
    comments = parsed.select(F.explode("_parsed.results").alias("r")).select("r.id", "r.comment")
    rejects = parsed.filter(F.col("_parsed.results").isNull()).drop("_parsed")
    return comments, rejects
