"""Severity-graded data quality: report, quarantine, clean, publish.

A rule names what breaks it. Rules that look at one row compile to Columns and
share one scan. Uniqueness and membership first reduce a column to its distinct
values with counts, combining per task, so a value held by very many rows costs
no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_lake.sources.tables import write_stage

# Severities and statuses, mildest first.
SUCCESS, WARNING, FAILED = "SUCCESS", "WARNING", "FAILED"
RANKED = [SUCCESS, WARNING, FAILED]
# Fixed value: length of the sample of broken values in a report.
SAMPLE_SIZE = 20


@dataclass(frozen=True)
class Rule:
    """``keep_row=False`` lets cleaning drop the rows that break the rule.

    ``reference`` is the column that identifies a row in reports.
    """

    column: str
    description: str
    severity: str = FAILED
    keep_row: bool = True
    reference: str = "id"

    def violating(self, df: DataFrame) -> DataFrame:
        """Rows that break the rule."""
        return df.filter(self.broken())

    def satisfying(self, df: DataFrame) -> DataFrame:
        """Rows that do not."""
        return df.filter(~self.broken())

    def count(self, df: DataFrame) -> DataFrame:
        """One row with the number of rows that break the rule, as ``broken``."""
        return df.agg(F.count_if(self.broken()).alias("broken"))

    def broken(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InSet(Rule):
    """Value in a short list; nulls pass."""

    values: tuple = ()

    def broken(self) -> Column:
        return F.coalesce(~F.col(self.column).isin(list(self.values)), F.lit(False))


@dataclass(frozen=True)
class Between(Rule):
    """Value within bounds, either of them open; nulls pass."""

    low: float | None = None
    high: float | None = None
    strict_low: bool = False

    def broken(self) -> Column:
        value, tests = F.col(self.column), []
        if self.low is not None:
            tests.append(value <= self.low if self.strict_low else value < self.low)
        if self.high is not None:
            tests.append(value > self.high)
        return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def _text(df: DataFrame, name: str) -> Column:
    """A column's value as text that is equal where the values are."""
    return (F.col(name) + 0.0 if dict(df.dtypes)[name] in ("float", "double") else F.col(name)).cast("string")


@dataclass(frozen=True)
class ByValue(Rule):
    """A rule decided by the distinct values of the column.

    ``found`` holds the bad values, as text, once they have been looked up.
    """

    found: DataFrame | None = field(default=None, compare=False, kw_only=True)

    def settled(self, df: DataFrame) -> ByValue:
        """The same rule with its bad values looked up, for report and cleaning to share."""
        return settle(df, [self])[0]

    def bad(self, rows: Column, known: Column) -> Column:
        """Whether a value with so many rows, that is known or not, breaks the rule."""
        raise NotImplementedError

    def known_values(self) -> tuple[DataFrame, str] | None:
        """The table and column of known values, if the rule has one."""
        return None

    def violating(self, df: DataFrame) -> DataFrame:
        bad = self.settled(df).found.select("_value")
        return df.join(bad, _text(df, self.column) == F.col("_value"), "left_semi")

    def satisfying(self, df: DataFrame) -> DataFrame:
        bad = self.settled(df).found.select("_value")
        return df.join(bad, _text(df, self.column) == F.col("_value"), "left_anti")

    def count(self, df: DataFrame) -> DataFrame:
        bad = bad_values(df, [(1, self)]) if self.found is None else self.found
        return bad.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("broken"))


@dataclass(frozen=True)
class Unique(ByValue):
    """No repeated value; every copy breaks the rule, nulls pass."""

    def bad(self, rows: Column, known: Column) -> Column:
        return rows > 1


@dataclass(frozen=True)
class DistinctInSet(ByValue):
    """Value found in a reference table; nulls pass."""

    known: DataFrame = field(default=None, compare=False)
    known_column: str = "id"

    def bad(self, rows: Column, known: Column) -> Column:
        return (rows > 0) & ~known

    def known_values(self) -> tuple[DataFrame, str] | None:
        return self.known, self.known_column


def bad_values(df: DataFrame, numbered: list[tuple[int, ByValue]]) -> DataFrame:
    """``position``, ``_value`` and ``_rows`` of each value that breaks its by-value rule.

    One aggregate for any number of rules, which combines per task: the values
    of all their columns, and the known values beside them.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    cells = [F.when(F.col(r.column).isNotNull(), F.struct(F.lit(p).alias("position"), _text(df, r.column).alias("_value")))
             for p, r in numbered]
    parts = [df.select(F.inline(F.array_compact(F.array(*cells)))).withColumns({"_n": F.lit(1), "_known": F.lit(False)})]
    for p, rule in numbered:
        if rule.known_values():
            table, name = rule.known_values()
            typed = table.select(F.col(name).try_cast(kinds[rule.column]).alias(name))
            parts.append(typed.select(
                F.lit(p).alias("position"), _text(typed, name).alias("_value"), F.lit(0).alias("_n"),
                F.lit(True).alias("_known")).filter(F.col("_value").isNotNull()))
    values = reduce(DataFrame.unionByName, parts).groupBy("position", "_value").agg(
        F.sum("_n").alias("_rows"), F.bool_or("_known").alias("_known"))
    broken = reduce(lambda found, pr: F.when(F.col("position") == pr[0], pr[1].bad(F.col("_rows"), F.col("_known"))).otherwise(
        found), numbered, F.lit(False))
    return values.filter(broken).select("position", "_value", "_rows")


def settle(df: DataFrame, suite: list[Rule]) -> list[Rule]:
    """The suite with the bad values of its by-value rules looked up, all by one aggregate.

    They are a written table: the planner knows from its size whether it may be
    broadcast; where it may not, AQE can split an oversized side, which it
    cannot next to an aggregate on the same key.
    """
    todo = [(p, r) for p, r in enumerate(suite) if isinstance(r, ByValue) and r.found is None]
    if not todo:
        return suite
    found = write_stage(bad_values(df, todo), name="values")
    settled = {p: replace(r, found=found.filter(F.col("position") == p).drop("position")) for p, r in todo}
    return [settled.get(p, r) for p, r in enumerate(suite)]


def rank(status: Column) -> Column:
    """Place of a status among the ranked ones, from 1."""
    return F.array_position(F.array(*[F.lit(s) for s in RANKED]), status)


def ranked_status(place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in RANKED]), place.cast("int"))


def violations(
    df: DataFrame, suite: list[Rule], stored: str | None = None, dropping: bool = False
) -> DataFrame:
    """One row per broken rule and row: ``position, rule, reference, value``.

    None is left out. All rules on single rows share one scan. ``stored`` names
    a struct of the columns as they are stored; references and values then
    come from there, so that columns made readable for the tests are not shown.
    ``dropping`` looks at the rules that drop rows only, and evaluates no other.
    """
    def shown(name: str) -> Column:
        return (F.col(stored)[name] if stored else F.col(name)).cast("string")

    def entry(position: int, rule: Rule) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(rule.description).alias("rule"),
            shown(rule.reference).alias("reference"), shown(rule.column).alias("value"),
        )

    chosen = [(p, r) for p, r in enumerate(suite, 1) if not (dropping and r.keep_row)]
    if not chosen:
        return df.sparkSession.createDataFrame([], "position int, rule string, reference string, value string")
    numbered = [(p, r) for (p, _), r in zip(chosen, settle(df, [r for _, r in chosen]))]
    direct = [(p, r) for p, r in numbered if not isinstance(r, ByValue)]
    by_value = [(p, r) for p, r in numbered if isinstance(r, ByValue)]
    parts = []
    if by_value:
        cells = F.array(*[F.struct(F.lit(p).alias("_p"), _text(df, r.column).alias("_v"), entry(p, r).alias("v"))
                          for p, r in by_value])
        bad = reduce(DataFrame.unionByName, [r.found.select(F.lit(p).alias("_position"), "_value") for p, r in by_value])
        same = (F.col("_p") == F.col("_position")) & (F.col("_v") == F.col("_value"))
        parts.append(df.select(F.inline(cells)).join(bad, same, "left_semi").select("v.*"))
    if direct:
        found = F.array_compact(F.array(*[F.when(r.broken(), entry(p, r)) for p, r in direct]))
        parts.append(df.select(F.explode(found).alias("v")).select("v.*"))
    return reduce(DataFrame.unionByName, parts)


def samples(found: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first violations per rule as text, for reading.

    The row limit is applied per task before the shuffle, so the collected
    lists stay short whatever the number of violations.
    """
    shown = F.concat(
        F.coalesce("reference", F.lit("null")), F.lit(" -> "), F.coalesce("value", F.lit("null")))
    first = Window.partitionBy("position").orderBy("shown")
    return (
        found.select("position", shown.alias("shown"))
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= size)
        .groupBy("position")
        .agg(F.concat_ws("; ", F.array_sort(F.collect_list("shown"))).alias("sample"))
    )


def run_suite(
    df: DataFrame, suite: list[Rule], with_sample: bool = True, sample_size: int = SAMPLE_SIZE
) -> DataFrame:
    """Report with one row per rule.

    ``position, rule, severity, result, broken`` and, if asked for, ``sample``:
    the first ``sample_size`` violations, a reading aid. ``violations`` lists
    them all. Counts are exact. The shuffles do not grow with the suite: one to
    look up bad values, one for the samples, one for the report, and two more
    where the bad values are too many to be broadcast.
    """
    suite = settle(df, suite)
    numbered = list(enumerate(suite, 1))
    direct = [F.when(r.broken(), F.lit(p)) for p, r in numbered if not isinstance(r, ByValue)]
    parts = [
        r.found.select(F.lit(p).alias("position"), F.col("_rows").alias("broken"))
        for p, r in numbered if isinstance(r, ByValue)
    ]
    if direct:
        broken = df.select(F.explode(F.array_compact(F.array(*direct))).alias("position"))
        parts.append(broken.withColumn("broken", F.lit(1).cast("long")))
    return _report(df, parts, suite, samples(violations(df, suite), sample_size) if with_sample else None)


def report_of(found: DataFrame, suite: list[Rule], sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """The same report from the listed violations, which are a written table."""
    counts = found.select("position", F.lit(1).cast("long").alias("broken"))
    return _report(found, [counts], suite, samples(found, sample_size))


def _report(df: DataFrame, counts: list[DataFrame], suite: list[Rule], sampled: DataFrame | None) -> DataFrame:
    """One aggregate over the counts of broken rows, the samples, and a zero for each rule."""
    numbered = list(enumerate(suite, 1))
    zeros = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(p) for p, _ in numbered])).alias("position"), F.lit(0).cast("long").alias("broken"))
    none = F.lit(None).cast("string")
    parts = [part.withColumn("sample", none) for part in [zeros, *counts]]
    if sampled is not None:
        parts.append(sampled.select("position", F.lit(0).cast("long").alias("broken"), "sample"))
    total = reduce(DataFrame.unionByName, parts).groupBy("position").agg(
        F.sum("broken").alias("broken"), F.max("sample").alias("sample"))
    # The suite itself is a short list, so its texts go in as a literal map.
    texts = F.create_map(*[c for p, r in numbered for c in (
        F.lit(p), F.struct(F.lit(r.description).alias("rule"), F.lit(r.severity).alias("severity")))])
    about = texts[F.col("position")]
    result = F.when(F.col("broken") == 0, SUCCESS).when(F.col("severity") == FAILED, FAILED).otherwise(WARNING)
    report = total.select(
        "position", about["rule"].alias("rule"), about["severity"].alias("severity"), "broken", "sample"
    ).withColumn("result", result)
    return report if sampled is not None else report.drop("sample")


def suite_status(report: DataFrame) -> DataFrame:
    """One row with the worst result as ``status``."""
    return report.agg(ranked_status(F.max(rank(F.col("result")))).alias("status"))


def status_of(report: DataFrame) -> str:
    """The status as a value, for a gate."""
    return suite_status(report).first()["status"]


def keep_valid(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """Rows that break none of the rules that drop rows."""
    return reduce(lambda kept, rule: rule.satisfying(kept),
                  _droppers(suite), df)


def _droppers(suite: list[Rule]) -> list[Rule]:
    # Row rules first: they shrink the input of those that need a shuffle.
    return sorted((r for r in suite if not r.keep_row), key=lambda r: isinstance(r, ByValue))


def clean(df: DataFrame, suite: list[Rule], status: str | None = None) -> DataFrame:
    """Rows fit for publishing; none, with the same columns, when the suite fails."""
    suite = settle(df, suite)
    status = status or status_of(run_suite(df, suite, with_sample=False))
    return df.filter(F.lit(False)) if status == FAILED else keep_valid(df, suite)


def quarantine(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """What cleaning drops: rule, reference and value of each reason."""
    return violations(df, suite, dropping=True)


def publish(
    df: DataFrame,
    suite: list[Rule],
    path: str,
    reveal: Callable[[DataFrame], DataFrame] | None = None,
    violations_path: str | None = None,
    sample_size: int = SAMPLE_SIZE,
) -> tuple[str, DataFrame]:
    """Write, audit, publish.

    The staged copy feeds report and result alike. Nothing is written to
    ``path`` when the suite fails. All violations are written, with the severity
    of their rule and whether they drop the row, to ``violations_path`` if it
    is given; the report samples them. ``reveal`` makes encrypted columns
    readable for the tests alone: stage, violations, report and result keep
    them as given, and no by-value rule may be on such a column. Returns the
    status and the report.
    """
    written = write_stage(df, name="audit")
    stored = "_stored" if reveal else None
    staged = reveal(written.withColumn(stored, F.struct(*df.columns))) if reveal else written
    suite = settle(staged, suite)
    about = F.create_map(*[c for p, r in enumerate(suite, 1) for c in (
        F.lit(p), F.struct(F.lit(r.severity).alias("severity"), F.lit(not r.keep_row).alias("drops_row")))])
    found = write_stage(
        violations(staged, suite, stored).select("*", about[F.col("position")].alias("_about")).select(
            "position", "rule", "_about.*", "reference", "value"), violations_path, name="violations")
    report = write_stage(report_of(found, suite, sample_size), name="report")
    status = status_of(report)
    if status != FAILED:
        valid = clean(staged, suite, status)
        (valid.select(f"{stored}.*") if stored else valid).write.mode("overwrite").parquet(path)
    return status, report


def reconcile(
    hr: DataFrame, sport: DataFrame, merged: DataFrame, audited: DataFrame | None = None
) -> DataFrame:
    """Four checks after the merge: ``position, rule, severity, found, result``.

    Compared with the cleaned HR set, so that rows dropped by validation do
    not count as lost. ``audited`` has the ids of all employees that were
    audited, dropped ones too: the sport of an employee dropped for another
    reason is no orphan. One aggregate over the ids answers all four.
    """
    def side(df: DataFrame, declared: Column = F.lit(0), **flags: int) -> DataFrame:
        marks = [F.lit(flags.get(f, 0)).alias(f) for f in ("hr", "merged", "sport", "known")]
        return df.select(F.col("id").cast("string").alias("id"), *marks, declared.alias("declared"))

    known = merged if audited is None else audited
    sides = [
        side(hr, hr=1), side(merged, merged=1), side(known, known=1),
        side(sport, F.col("sport_type").isNotNull().cast("int"), sport=1),
    ]
    by_id = reduce(DataFrame.unionByName, sides).groupBy("id").agg(
        *[F.sum(c).alias(c) for c in ("hr", "merged", "sport", "known", "declared")])
    matched = lambda c: F.col("id").isNotNull() & (F.col(c) > 0)  # noqa: E731  a null id matches nothing

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    found = by_id.agg(
        F.abs(total(F.col("hr") - F.col("merged"))).alias("_1"),
        total(F.when(~matched("sport"), F.col("merged"))).alias("_2"),
        total(F.when(~matched("known"), F.col("sport"))).alias("_3"),
        total(F.when(~matched("known"), F.col("declared"))).alias("_4"))
    # Severities of the four checks.
    rules = [("every employee kept", FAILED), ("every employee has a sport row", WARNING),
             ("no sport row without employee", WARNING), ("no declared sport without employee", FAILED)]
    entries = [
        F.struct(F.lit(p).alias("position"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                 F.col(f"_{p}").alias("found"))
        for p, (rule, severity) in enumerate(rules, 1)
    ]
    failed = F.when(F.col("found") == 0, SUCCESS).otherwise(F.col("severity"))
    return found.select(F.explode(F.array(*entries)).alias("c")).select("c.*").withColumn("result", failed)


def orphan_sports(sport: DataFrame, merged: DataFrame) -> DataFrame:
    """Declared sports of ids that are no employee."""
    extra = sport.join(merged.select("id").distinct(), "id", "left_anti")
    return extra.filter(F.col("sport_type").isNotNull())
