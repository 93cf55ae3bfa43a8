"""Snapshot comparison and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.dates import epoch_micros
from activity_lake.functions.text import digest, record_text
from activity_lake.sources.tables import write_stage


def fingerprint(df: DataFrame, cols: list[str] | None = None, algorithm: str = "md5") -> DataFrame:
    """Add ``fingerprint``, a hash of the business columns as text.

    Columns must have their declared types, since a value's text enters the
    hash; timestamps enter as epoch microseconds. ``xxhash64`` is the faster,
    64-bit choice; it skips nulls, so each value enters with its null flag.
    """
    cols = cols or schemas.FINGERPRINT_COLUMNS
    types = dict(df.dtypes)
    parts = [epoch_micros(c) if types[c].startswith("timestamp") else F.col(c) for c in cols]
    value = digest(*parts) if algorithm == "md5" else F.xxhash64(
        *[x for p in parts for x in (p.isNull(), p)]).cast("string")
    return df.withColumn("fingerprint", value)


def diff_labels(
    incoming: DataFrame,
    stored: DataFrame,
    key: str = "id",
    mark: str = "fingerprint",
    unique: bool = False,
) -> DataFrame:
    """Key, fingerprint, ``_merge`` and ``status`` of each differing image.

    Only keys and fingerprints are read and shuffled. ``unique`` states that
    no key repeats on either side, as after the uniqueness rule; one join on
    the key then does. Otherwise images are counted in an aggregate over both
    sides, which combines per task, so that repeated keys never pile up.
    """
    left = incoming.select(key, mark).filter(F.col(key).isNotNull())
    right = stored.select(key, mark).filter(F.col(key).isNotNull())
    if unique:
        return _unique_labels(left, right, key, mark)
    both = left.withColumn("_in", F.lit(1)).unionByName(right.withColumn("_in", F.lit(0)))
    images = both.groupBy(key, mark).agg(
        F.sum("_in").alias("_left"), F.sum(1 - F.col("_in")).alias("_right"))
    changed = write_stage(images.filter("_left = 0 or _right = 0").select(
        key, mark, (F.col("_left") + F.col("_right")).alias("_copies"),
        F.when(F.col("_left") > 0, "left_only").otherwise("right_only").alias("_merge"),
    ), name="changed")
    several = changed.groupBy(key).agg(F.sum("_copies").alias("_images")).filter("_images > 1")
    labelled = changed.join(write_stage(several, name="several"), key, "left")
    status = (
        F.when(F.col("_images").isNotNull(), "modified")
        .when(F.col("_merge") == "right_only", "deleted").otherwise("new")
    )
    return labelled.select(key, mark, "_merge", status.alias("status"))


def _unique_labels(left: DataFrame, right: DataFrame, key: str, mark: str) -> DataFrame:
    # A struct tells a missing side from a null mark.
    new, old = F.col("_new"), F.col("_old")
    both = left.select(key, F.struct(mark).alias("_new")).join(
        right.select(key, F.struct(mark).alias("_old")), key, "full_outer")
    changed = both.filter(~new.eqNullSafe(old))
    status = F.when(old.isNull(), "new").when(new.isNull(), "deleted").otherwise("modified")

    def image(side: Column, name: str) -> Column:
        return F.when(side.isNotNull(), F.struct(side[mark].alias(mark), F.lit(name).alias("_merge")))

    images = F.array_compact(F.array(image(new, "left_only"), image(old, "right_only")))
    return changed.select(key, status.alias("status"), F.explode(images).alias("_image")).select(
        key, f"_image.{mark}", "_image._merge", "status")


def snapshot_diff(
    incoming: DataFrame,
    stored: DataFrame,
    key: str = "id",
    mark: str = "fingerprint",
    labels: DataFrame | None = None,
) -> DataFrame:
    """Rows that differ between two snapshots, with ``_merge`` and ``status``.

    ``left_only`` rows are new images, ``right_only`` rows old ones; pairs
    equal in key and fingerprint are dropped. A key with several images left
    is ``modified``, a single one is ``new`` or ``deleted``.

    Whole rows are fetched for the labelled images only. The labels are a
    written table: its size is known when the fetch is planned, so that small
    differences are broadcast and the snapshots are not shuffled at all.
    """
    if labels is None:
        labels = write_stage(diff_labels(incoming, stored, key, mark), name="labels")

    def images(rows: DataFrame, side: str) -> DataFrame:
        wanted = labels.filter(F.col("_merge") == side).select(
            F.col(key).alias("_key"), F.col(mark).alias("_mark"), "_merge", "status")
        same = (F.col(key) == F.col("_key")) & F.col(mark).eqNullSafe(F.col("_mark"))
        return rows.join(wanted, same).select(*stored.columns, "_merge", "status")

    blank = [c for c in stored.columns if c not in incoming.columns]
    filled = incoming.withColumns({c: F.lit(None).cast(stored.schema[c].dataType) for c in blank})
    return images(filled, "left_only").unionByName(images(stored, "right_only"))


def mark_duplicates(df: DataFrame, key: str = "id", out: str = "duplicated") -> DataFrame:
    """Flag every row whose key occurs more than once.

    Only repeated keys are joined back, after a count that combines per task,
    as a written table: few are broadcast, many let AQE split a hot key.
    """
    repeated = df.groupBy(F.col(key).alias("_key")).count().filter("count > 1").drop("count")
    repeated = write_stage(repeated, name="repeated").withColumn("_repeated", F.lit(True))
    flagged = df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
    return flagged.withColumn(out, F.coalesce("_repeated", F.lit(False))).drop("_key", "_repeated")


def diff_summary(diff: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row of counts; a modified row is counted once, by its new image."""
    fresh = F.col("_merge") == "left_only"
    found = diff.agg(
        F.count_if(F.col("status") == "new").alias("new"),
        F.count_if(F.col("status") == "deleted").alias("deleted"),
        F.count_if((F.col("status") == "modified") & fresh).alias("modified"),
        F.count_if(fresh).alias("fresh"),
        F.lit(0).cast("long").alias("incoming"),
    )
    given = incoming.agg(
        *[F.lit(0).cast("long").alias(c) for c in ("new", "deleted", "modified", "fresh")],
        F.count("*").alias("incoming"),
    )
    total = found.unionByName(given).agg(
        *[F.sum(c).alias(c) for c in ("incoming", "new", "deleted", "modified", "fresh")])
    return total.select(
        "incoming", (F.col("incoming") - F.col("fresh")).alias("identical"),
        "new", "deleted", "modified",
    )


def diff_gate(summary: DataFrame) -> DataFrame:
    """Whether the flow goes on, and with which status."""
    anomalies = F.col("deleted") + F.col("modified")
    return summary.select(
        F.when(F.col("new") + anomalies > 0, "YES").otherwise("NO").alias("continue"),
        F.when(anomalies > 0, "WARNING").otherwise("SUCCESS").alias("status"),
    )


def pending(actions: DataFrame) -> DataFrame:
    """Actions to carry out; the old images of modified rows only inform."""
    old = (F.col("status") == "modified") & (F.col("_merge") == "right_only")
    return actions.filter(~old)


def chosen_actions(actions: DataFrame, key: str = "id") -> DataFrame:
    """One pending action per key; of several, that with the greatest fingerprint."""
    last = Window.partitionBy(key).orderBy(
        F.col("fingerprint").desc_nulls_last() if "fingerprint" in actions.columns else F.col("status"))
    return pending(actions).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def apply_changes(target: DataFrame, actions: DataFrame, key: str = "id") -> DataFrame:
    """The target with new, modified and deleted rows carried out.

    Untouched rows pass an anti join with the touched keys: when the actions
    are small it is a broadcast and the target is not shuffled at all. Write
    the result to a new folder, never over the one ``target`` is read from, and
    give ``actions`` as a written table, as they are read twice. It writes the
    whole target; ``streaming.state.record_changes`` writes the changes alone.
    """
    todo = pending(actions)
    chosen = chosen_actions(actions, key)
    kept = target.join(todo.select(key).distinct(), key, "left_anti").select(*target.columns)
    written = chosen.filter(F.col("status") != "deleted").select(*target.columns)
    return kept.unionByName(written)


def change_counts(actions: DataFrame) -> DataFrame:
    """Number of rows written per status."""
    return pending(actions).groupBy("status").agg(F.count("*").alias("rows"))


def change_audit(actions: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    """Old and new image of modified rows and the old image of deleted ones, as text."""
    def image(side: str) -> Column:
        return F.max(F.when(F.col("_merge") == side, record_text(*cols)))

    touched = actions.filter(F.col("status").isin("modified", "deleted"))
    return touched.groupBy(key, "status").agg(
        image("right_only").alias("old_values"), image("left_only").alias("new_values"))
