"""Totals per employee and social year, kept by adding new images and taking old ones back.

A micro-batch costs its own changes: for each it subtracts the row before and
adds the row after. Sums do not depend on order, so late events and deletes
need no state per row. Batches and snapshots are kept as those of the upserted
state are, so a batch counts once and half of one never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from activity_lake import schemas
from activity_lake.functions.dates import activity_date, social_year
from activity_lake.operators.cdc import cdc_images, first_deliveries
from activity_lake.sources.commits import BatchStore
from activity_lake.streaming.gold import foreach_batch

KIND = "differences of totals"
KEYS = ("employee_id", "social_year")
MEASURES = ("distance_meters", "duration_sec")
# A measure is null where no row has it, so the rows that do are counted beside the sum.
TOTALS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in KEYS],
    *[T.StructField(c, T.LongType()) for c in ("activities", *MEASURES, *[f"{m}_given" for m in MEASURES])],
])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(*[F.sum(f.name).alias(f.name) for f in TOTALS if f.name not in KEYS])


def total_changes(images: DataFrame, first_month: int = 6) -> DataFrame:
    """What changes (see ``cdc_images``) add to the totals, which may be less than nothing.

    An update or delete whose old row has nothing but its key cannot be taken
    back: the source has to log whole old rows, and the job fails if it does not.
    """
    old, new = F.col("before"), F.col("after")
    fields = [f for f in images.schema["before"].dataType.fieldNames() if f != "id"]
    bare = F.coalesce(*[old[f].cast("string") for f in fields]).isNull() & F.coalesce(F.col("op") != "c", F.lit(True))
    refused = F.raise_error(F.concat(F.lit("no old row is logged for "), F.col("id"))).cast("int")

    def side(sign: int, image: Column) -> Column:
        return F.when(image.isNotNull(), F.struct(F.lit(sign).alias("sign"), image.alias("row")))

    less = F.when(bare, refused).otherwise(F.lit(-1))
    taken = F.when(old.isNotNull() | bare, F.struct(less.alias("sign"), old.alias("row")))
    rows = images.select(F.inline(F.array_compact(F.array(
        F.when(F.col("op").isin("c", "r"), F.lit(None)).otherwise(taken), side(1, new))))).select("sign", "row.*")
    dated = rows.withColumn("social_year", social_year(activity_date("begin_date"), first_month))
    sign = F.col("sign").cast("long")
    return _summed(dated.select(
        *KEYS, sign.alias("activities"), *[(sign * F.col(m)).alias(m) for m in MEASURES],
        *[(sign * F.col(m).isNotNull().cast("long")).alias(f"{m}_given") for m in MEASURES]))


def start_totals(
    raw: DataFrame, path: str, checkpoint: str, once: bool = False, within: str | None = None, first_month: int = 6,
) -> StreamingQuery:
    """Keep the totals under ``path`` up to date.

    ``within`` drops events that are delivered again within that event time. Path
    and checkpoint belong together: a new checkpoint needs a new path.
    """
    store = BatchStore(raw.sparkSession, path)
    store.claim(KIND)
    images = cdc_images(raw, schemas.ACTIVITY_EVENT)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(total_changes(batch, first_month), batch_id)

    return foreach_batch(first_deliveries(images, within) if within else images, write, checkpoint, once)


def current_totals(spark: SparkSession, path: str) -> DataFrame:
    """What ``social_year_stats`` gives for the rows alive now."""
    parts, _ = BatchStore(spark, path).read(TOTALS)
    measures = [F.when(F.col(f"{m}_given") > 0, F.coalesce(m, F.lit(0))).alias(m) for m in MEASURES]
    return _summed(parts).filter("activities > 0").select(*KEYS, "activities", *measures)


def compact_totals(spark: SparkSession, path: str) -> int:
    """Write the sums as a new snapshot and then point to it; returns the last batch it covers."""
    store = BatchStore(spark, path)
    upto, _ = store.snapshot()
    parts, last = store.read(TOTALS)
    if last > upto:
        store.point(_summed(parts).filter("activities <> 0"), last)
    return last
