"""Nested place documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.text import first_filled

# What a place without city or category gets.
DEFAULT_CITY = "Hérault"
DEFAULT_CATEGORY = "lieu"


def flatten_places(docs: DataFrame, col: str = "document") -> DataFrame:
    """One row per named element; areas take the coordinates of their centre.

    A list of one keeps the parsed document from being computed again in filters.
    """
    parsed = docs.select(F.explode(F.array(F.from_json(col, schemas.PLACES))).alias("d"))
    named = parsed.select(F.explode("d.elements").alias("e")).filter(F.col("e.tags")["name"] != "")

    def tag(name: str):
        return F.col("e.tags")[name]

    def coordinate(name: str):
        # 0 counts as not given.
        return F.coalesce(F.nullif(F.col(f"e.{name}"), F.lit(0.0)), F.col(f"e.center.{name}"))

    return named.select(
        tag("name").alias("name"),
        first_filled(tag("addr:city"), tag("is_in:city"), default=DEFAULT_CITY).alias("city"),
        first_filled(tag("sport"), tag("leisure"), tag("natural"), default=DEFAULT_CATEGORY).alias("category"),
        coordinate("lat").alias("lat"),
        coordinate("lon").alias("lon"),
    )
