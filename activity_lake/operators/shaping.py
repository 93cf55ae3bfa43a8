"""Projections, masks, joins, order and batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.functions.text import normalize_text, strip
from activity_lake.sources.tables import write_stage

# Order of the join indicator; it is not the order of the texts.
INDICATOR_ORDER = ["left_only", "right_only", "both"]
# Files whose rows are summed together when rows are numbered.
PARTS_PER_BLOCK = 1000


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, in its order and types; unreadable values become null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Assign columns only where the condition holds."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def split_active(df: DataFrame, col: str = "sport_type") -> tuple[DataFrame, DataFrame]:
    """Rows with and rows without a declared sport."""
    return df.filter(F.col(col).isNotNull()), df.filter(F.col(col).isNull())


def stamp(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """Add the processing time."""
    return df.withColumn(name, F.current_timestamp())


# --- joins -----------------------------------------------------------------
# Only left, semi and anti joins are used: AQE can split an oversized left
# side for all of them, and they stream it without buffering a key's rows.
# Their right sides carry one row per key. Where that takes an aggregate its
# result is written first: AQE splits only between plain shuffles, and the
# planner then knows whether the table is small enough to broadcast.


def merge_hr_sport(hr: DataFrame, sport: DataFrame) -> DataFrame:
    return hr.join(sport, "id", "left")


def merge_indicator(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "outer", unique: bool = False
) -> DataFrame:
    """Join that says in ``_merge`` which side each row came from.

    Other columns of both sides take the left value where there is a left row
    and the right value otherwise. An outer join is a left join plus the right
    rows without a partner: a full outer join would buffer all rows of a key.
    ``unique`` states that no key repeats on either side; one join then does.
    """
    names = on + [c for c in left.columns if c not in on]
    names += [c for c in right.columns if c not in names]
    only_right = [c for c in right.columns if c not in left.columns]
    if unique:
        return _merge_unique(left, right, on, how, names)
    marked = right.select(*on, *only_right, F.lit(True).alias("_found"))
    merged = left.join(marked, on, "left").withColumn(
        "_merge", F.when(F.col("_found"), "both").otherwise("left_only"))
    merged = merged.select(*names, "_merge")
    if how == "left":
        return merged
    types = dict(merged.dtypes)
    rest = right.join(_keys(left, on), on, "left_anti")
    rest = rest.select(
        *[(F.col(c) if c in right.columns else F.lit(None)).cast(types[c]).alias(c) for c in names],
        F.lit("right_only").alias("_merge"),
    )
    return merged.unionByName(rest)


def _merge_unique(left: DataFrame, right: DataFrame, on: list[str], how: str, names: list[str]) -> DataFrame:
    ours = left.select(*on, F.struct(*left.columns).alias("_left"))
    theirs = right.select(*on, F.struct(*right.columns).alias("_right"))
    both = ours.join(theirs, on, "full_outer" if how == "outer" else "left")
    types = {**dict(right.dtypes), **dict(left.dtypes)}

    def value(c: str) -> Column:
        if c not in left.columns:
            return F.col("_right")[c]
        if c not in right.columns:
            return F.col("_left")[c]
        return F.when(F.col("_left").isNotNull(), F.col("_left")[c]).otherwise(F.col("_right")[c])

    side = F.when(F.col("_left").isNull(), "right_only").when(F.col("_right").isNull(), "left_only").otherwise("both")
    return both.select(*[value(c).cast(types[c]).alias(c) for c in names], side.alias("_merge"))


def _keys(df: DataFrame, on: list[str]) -> DataFrame:
    return write_stage(df.select(*on).distinct(), name="keys")


def orphans(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left rows without a partner."""
    return left.join(_keys(right, [on]), on, "left_anti")


def missing(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Right rows without a partner."""
    return orphans(right, left, on)


def exists_in(df: DataFrame, reference: DataFrame, key: str, reference_key: str = "id") -> DataFrame:
    """Rows whose key occurs in the reference table, which has one row per key."""
    known = reference.select(F.col(reference_key).alias(key))
    return df.join(known, key, "left_semi")


def enrich_names(activities: DataFrame, employees: DataFrame) -> DataFrame:
    """Add the employee's names; ``employees`` has one row per id."""
    names = employees.select(F.col("id").alias("employee_id"), "first_name", "last_name")
    return activities.join(names, "employee_id", "left")


def attach_comments(actions: DataFrame, comments: DataFrame) -> DataFrame:
    """New comments on fresh images; old images keep theirs.

    Should a writer answer twice for one id, the smallest text is taken.
    """
    written = comments.groupBy("id").agg(F.min("comment").alias("_written"))
    joined = actions.join(written, "id", "left")
    fresh = F.col("_merge") == "left_only"
    return update_where(joined, fresh, {"comment": F.col("_written")}).select(*actions.columns)


def alias_table(sports: DataFrame) -> DataFrame:
    """One row per alias; when two sports share one, the last listed wins."""
    listed = sports.select("position", "sport", F.explode(F.split("alias", ",")).alias("alias"))
    return (
        listed.withColumn("alias", strip("alias"))
        .groupBy("alias").agg(F.max(F.struct("position", "sport"))["sport"].alias("sport"))
    )


def normalize_sport(df: DataFrame, sports: DataFrame, col: str = "sport_type", out: str = "official") -> DataFrame:
    """Official name of a raw sport: by alias, then by name, else null.

    Names that normalise alike resolve to the first listed. Aliases are only
    trimmed, so a name in capitals or accents never matches one.
    """
    names = (
        sports.groupBy(normalize_text("sport").alias("_key"))
        .agg(F.min(F.struct("position", "sport"))["sport"].alias("_by_name"))
    )
    aliases = alias_table(sports).select(F.col("alias").alias("_key"), F.col("sport").alias("_by_alias"))
    dimension = names.join(aliases, "_key", "full_outer").select(
        "_key", F.coalesce("_by_alias", "_by_name").alias(out))
    key = F.when(F.col(col) != "", normalize_text(col))
    dimension = write_stage(dimension, name="sports")
    return df.withColumn("_key", key).join(dimension, "_key", "left").drop("_key")


# --- order, limits, batches ------------------------------------------------


def sort_by_indicator(df: DataFrame, then: tuple[str, ...] = ("id", "fingerprint")) -> DataFrame:
    """Left-only rows, then right-only ones, then both.

    The indicator has three values only; the further columns let the sort use
    more than three tasks.
    """
    place = F.array_position(F.array(*[F.lit(v) for v in INDICATOR_ORDER]), F.col("_merge"))
    return df.orderBy(place, *then)


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first rows in key order, for trial runs."""
    return df.orderBy(key).limit(n)


def dedupe(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row of each key in the given order, chosen per task before the shuffle."""
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def changed_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Distinct keys that occur more than once."""
    return df.groupBy(key).count().filter("count > 1").select(key)


def share(df: DataFrame, group: str, weight: str, out: str = "share") -> DataFrame:
    """Weight over the total weight of its group.

    Totals are summed per task first and joined back, so a large group is
    never gathered in one task.
    """
    totals = df.groupBy(F.col(group).alias("_group")).agg(F.sum(weight).alias("_total"))
    totals = write_stage(totals, name="totals")
    joined = df.join(totals, F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.withColumn(out, F.try_divide(weight, "_total")).drop("_group", "_total")


def with_batch(df: DataFrame, size: int = 100, order: tuple[str, ...] = ()) -> DataFrame:
    """Number rows into batches of ``size`` by position; only the last may be short.

    The rows are written once, sorted if an order is given. A row's place is
    its index in its file plus the rows of the files before, so numbering takes
    no shuffle, does not depend on keys, and a repeated task finds the same
    numbers. The table of files is written too, for the planner to see its size.
    """
    staged = write_stage(df.orderBy(*order) if order else df, name="batches")
    placed = staged.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # Files are numbered as parts, with five digits or more: order by the number.
    # Their rows are summed in blocks of parts, so that no task sees all files.
    part = F.regexp_extract("_file", r"/part-(\d+)-[^/]*$", 1).cast("long")
    files = placed.groupBy("_file").count().select(
        "_file", "count", part.alias("_part"), F.floor(part / PARTS_PER_BLOCK).alias("_block"))
    files = write_stage(files, name="parts")
    within = Window.partitionBy("_block").orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = files.groupBy("_block").agg(F.sum("count").alias("_rows")).select(
        "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_earlier"))
    files = files.withColumn("_within", F.coalesce(F.sum("count").over(within), F.lit(0))).join(
        blocks, "_block").select("_file", (F.col("_earlier") + F.col("_within")).alias("_shift"))
    numbered = placed.join(write_stage(files, name="files"), "_file")
    batch = F.floor((F.col("_shift") + F.col("_row")) / size)
    return numbered.select(*df.columns, batch.alias("batch"))


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
