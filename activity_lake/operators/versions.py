"""A table in key buckets, each version of which names the folders of its buckets.

Rows go to buckets by a hash of their key. A change rewrites the buckets that
it touches and leaves the others where they are. A version is one small file
with a line per bucket: its folder, its number of rows and a digest of its keys
and fingerprints that does not depend on their order. Readers see one version
whole. Two snapshots are compared by their digests first, and rows are read of
the buckets only whose digests differ.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.operators.diff import apply_changes, diff_labels, pending, snapshot_diff
from activity_lake.sources.commits import get_file, names, put_file
from activity_lake.sources.tables import remove_path, write_stage

# Name of the bucket's column in files and comparisons.
BUCKET = "key_bucket"


@dataclass(frozen=True)
class Bucket:
    """One bucket of a version."""

    folder: str
    rows: int
    digest: str


@dataclass(frozen=True)
class BucketTable:
    """A table under ``path``; make one with ``create`` and find it again with ``open_table``.

    Keys are unique and not null. ``mark`` is the column with the fingerprint.
    The driver holds one line per bucket: choose ``buckets`` so that one has
    some hundred MB, and a table of 100 TB has some hundred thousand.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str = "id"
    mark: str = "fingerprint"
    buckets: int = 64

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str = "id", mark: str = "fingerprint", buckets: int = 64) -> BucketTable:
        """Write the rows as version 0."""
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        table = cls(df.sparkSession, path, schema, key, mark, buckets)
        put_file(table.spark, f"{path}/table.json", json.dumps(
            {"schema": schema.jsonValue(), "key": key, "mark": mark, "buckets": buckets}))
        table.commit(df, set(range(buckets)))
        return table

    @classmethod
    def open_table(cls, spark: SparkSession, path: str) -> BucketTable:
        about = json.loads(get_file(spark, f"{path}/table.json"))
        return cls(spark, path, T.StructType.fromJson(about["schema"]), about["key"], about["mark"], about["buckets"])

    def bucket(self, key: str | Column | None = None) -> Column:
        """The bucket of a key."""
        key = F.col(self.key) if key is None else key
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # --- versions

    def version(self) -> int:
        """Number of the newest version; -1 before the first."""
        return max((int(n) for n in names(self.spark, f"{self.path}/versions") if n.isdigit()), default=-1)

    def manifest(self, version: int | None = None) -> dict[int, Bucket]:
        """The buckets of a version that have rows."""
        version = self.version() if version is None else version
        text = get_file(self.spark, f"{self.path}/versions/{version}")
        if text is None:
            return {}
        lines = map(json.loads, text.splitlines())
        return {line.pop(BUCKET): Bucket(**line) for line in lines}

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets: only their folders are listed and read."""
        found = self.manifest(version)
        wanted = sorted(found if buckets is None else buckets & found.keys())
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self.path}/data/{found[b].folder}/{BUCKET}={b}" for b in wanted])

    def commit(self, rows: DataFrame, touched: set[int]) -> int:
        """A new version in which ``rows`` are all that the touched buckets hold.

        A folder is written first and the version appears after it, in one
        step; a writer that another one has overtaken is refused.
        """
        last = self.version()
        kept = {b: x for b, x in self.manifest(last).items() if b not in touched}
        folder = f"{last + 1}-{uuid.uuid4().hex}"
        placed = rows.select(*self.schema.fieldNames(), self.bucket().alias(BUCKET))
        placed.repartition(max(1, len(touched)), BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        written = self.spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")
        for line in self.digests(written, F.col(BUCKET)).collect():
            kept[line[BUCKET]] = Bucket(folder, line["rows"], line["digest"])
        put_file(self.spark, f"{self.path}/versions/{last + 1}", "\n".join(
            json.dumps({BUCKET: b, **vars(x)}) for b, x in sorted(kept.items())))
        return last + 1

    def prune(self, keep: int = 2) -> int:
        """Remove versions but the last ``keep``, and buckets that none of these names; returns how many folders.

        Folders of versions that are still being written are left alone.
        """
        last = self.version()
        held = [n for n in range(max(0, last - keep + 1), last + 1)]
        used = {(x.folder, f"{BUCKET}={b}") for n in held for b, x in self.manifest(n).items()}
        for name in names(self.spark, f"{self.path}/versions"):
            if name.isdigit() and int(name) < held[0]:
                remove_path(self.spark, f"{self.path}/versions/{name}")
        removed = 0
        for folder in names(self.spark, f"{self.path}/data"):
            if int(folder.partition("-")[0]) > last:
                continue
            inside = {(folder, name) for name in names(self.spark, f"{self.path}/data/{folder}")}
            for _, name in inside - used:
                remove_path(self.spark, f"{self.path}/data/{folder}/{name}")
                removed += 1
            if not inside & used:
                remove_path(self.spark, f"{self.path}/data/{folder}")
        return removed

    # --- comparing

    def digests(self, rows: DataFrame, bucket: Column | None = None) -> DataFrame:
        """``rows`` and ``digest`` per bucket: one aggregate over keys and fingerprints, which combines per task.

        Two sums of 64-bit hashes with different beginnings, so that no order
        counts and equal sums of unequal rows need not be feared.
        """
        key, mark = F.col(self.key), F.col(self.mark)
        given = rows.filter(key.isNotNull())
        sums = [F.sum(F.xxhash64(F.lit(start), mark.isNull(), key, mark).cast("decimal(38,0)")) for start in (1, 2)]
        return given.groupBy((self.bucket() if bucket is None else bucket).alias(BUCKET)).agg(
            F.count("*").alias("rows"), F.concat_ws(",", *[s.cast("string") for s in sums]).alias("digest"))

    def differing(self, incoming: DataFrame, version: int | None = None) -> set[int]:
        """Buckets in which a snapshot and a version are not the same."""
        found = {b: (x.rows, x.digest) for b, x in self.manifest(version).items()}
        given = {d[BUCKET]: (d["rows"], d["digest"]) for d in self.digests(incoming).collect()}
        return {b for b in found.keys() | given.keys() if found.get(b) != given.get(b)}

    def within(self, rows: DataFrame, buckets: set[int]) -> DataFrame:
        """The rows that belong to some buckets."""
        if len(buckets) == self.buckets:
            return rows.filter(F.col(self.key).isNotNull())
        if not buckets:
            return rows.filter(F.lit(False))
        wanted = write_stage(self.spark.createDataFrame([(b,) for b in sorted(buckets)], f"{BUCKET} int"), name="buckets")
        return rows.withColumn(BUCKET, self.bucket()).join(wanted, BUCKET, "left_semi").select(*rows.columns)

    def compare(self, incoming: DataFrame, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(incoming rows, stored rows) of the buckets that differ; the others are not read."""
        buckets = self.differing(incoming, version)
        return self.within(incoming, buckets), self.read(version, buckets)

    def diff(self, incoming: DataFrame, version: int | None = None) -> DataFrame:
        """What ``snapshot_diff`` gives for a snapshot of unique keys and a version."""
        left, right = self.compare(incoming, version)
        labels = write_stage(diff_labels(left, right, self.key, self.mark, unique=True), name="labels")
        return snapshot_diff(left, right, self.key, self.mark, labels)

    def apply(self, actions: DataFrame) -> int:
        """A new version with the actions carried out, in the buckets that they touch.

        ``actions`` is a written table. Without any pending action the version
        stays as it is.
        """
        touched = {r[BUCKET] for r in pending(actions).select(self.bucket().alias(BUCKET)).distinct().collect()}
        if not touched:
            return self.version()
        return self.commit(apply_changes(self.read(buckets=touched), actions, self.key), touched)
