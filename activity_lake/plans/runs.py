"""The run table: what every step of a job did, kept by the jobs themselves.

A step is one small file that appears when it ends, so the table is there
whatever becomes of the job, and a run costs no Spark job of its own. Row
counts come from the writes that the steps do anyway.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from activity_lake.operators.quality import FAILED, SUCCESS
from activity_lake.operators.reporting import observed
from activity_lake.sources.commits import put_file
from activity_lake.sources.tables import read_or_empty

RUN_STEP = T.StructType([
    T.StructField("flow", T.StringType()), T.StructField("run", T.StringType()), T.StructField("place", T.IntegerType()),
    T.StructField("step", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("started", T.TimestampType()), T.StructField("ended", T.TimestampType()),
    T.StructField("rows", T.LongType()), T.StructField("columns", T.IntegerType()),
    T.StructField("message", T.StringType()),
])


@dataclass
class Step:
    """What a step says of itself: ``status``, the table that it ``counts``, a ``message``."""

    status: str = SUCCESS
    message: str | None = None
    columns: int | None = None
    _seen: Observation | None = None

    def counts(self, df: DataFrame) -> DataFrame:
        """The same rows, counted by the first write of them."""
        df, self._seen = observed(df, f"rows-{uuid.uuid4().hex}")
        self.columns = len(df.columns)
        return df

    def rows(self) -> int | None:
        return self._seen.get["rows"] if self._seen else None


@dataclass
class RunLog:
    """Steps of one run of a flow, under ``path``. A run that is repeated under its name adds steps to it."""

    spark: SparkSession
    path: str
    flow: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    _place: int = 0

    @contextmanager
    def step(self, name: str) -> Iterator[Step]:
        """Record a step; one that raises is recorded as failed, with the error, and raises on."""
        step, started = Step(), dt.datetime.now(dt.timezone.utc)
        try:
            yield step
        except BaseException as error:
            self._put(name, started, FAILED, None, None, f"{type(error).__name__}: {error}"[:2000])
            raise
        self._put(name, started, step.status, step.rows(), step.columns, step.message)

    def _put(self, name, started, status, rows, columns, message) -> None:
        line = {
            "flow": self.flow, "run": self.run, "place": self._place, "step": name, "status": status,
            "started": started.isoformat(), "ended": dt.datetime.now(dt.timezone.utc).isoformat(),
            "rows": rows, "columns": columns, "message": message}
        put_file(self.spark, f"{self.path}/{self.run}-{self._place}-{uuid.uuid4().hex}.json", json.dumps(line))
        self._place += 1


def run_table(spark: SparkSession, path: str) -> DataFrame:
    """The recorded steps, as ``rollup`` and ``alerts`` take them; none before the first."""
    return read_or_empty(spark, path, RUN_STEP, "json")
