"""Records of sheets whose cells hold line breaks, read by many tasks.

A line break ends a record where the quotes before it are even in number. Tasks
count the quotes of their own lines; the sums over the blocks before give each
block the parity that it starts with, and the number of its first record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.sources.tables import write_stage

QUOTE = '"'
# A record of more lines has lost its closing quote; its lines are given one by one.
MAX_LINES = 10_000

_LINE = "file string, block long, line long, value string, quotes long, inside long, even long, odd long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each block, with what is known of their place.

    ``inside`` is the parity of the quotes before the line; ``even`` and ``odd``
    are its record's number if the block starts outside or inside of quotes.
    """
    at, line, quotes, starts = None, 0, 0, [0, 0]
    for batch in batches:
        file, block = batch.column("file").to_pylist(), batch.column("block").to_numpy()
        found = pc.count_substring(batch.column("value"), QUOTE).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *[i for i in range(1, len(file)) if (file[i], block[i]) != (file[i - 1], block[i - 1])], len(file)]
        parts = []
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if (file[a], block[a]) != at:
                at, line, quotes, starts = (file[a], block[a]), 0, 0, [0, 0]
            total = quotes + np.cumsum(found[a:b])
            inside = (total - found[a:b]) % 2
            numbers = [starts[p] + np.cumsum(inside == p) for p in (0, 1)]
            parts.append((line + np.arange(b - a), inside, *numbers))
            line, quotes, starts = line + b - a, int(total[-1]), [int(n[-1]) for n in numbers]
        columns = [np.concatenate(c) if parts else np.zeros(0, np.int64) for c in (zip(*parts) if parts else [[]] * 4)]
        lines, inside, even, odd = [pa.array(c.astype(np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("block"), lines, batch.column("value"), pa.array(found), inside, even, odd],
            ["file", "block", "line", "value", "quotes", "inside", "even", "odd"])


def quoted_records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """``file``, ``number`` (from 1) and ``record`` of all records, blank lines left out.

    Lines are counted where they are read. Only those of records with a line
    break are brought together; the others stay in their tasks, as the table of
    blocks is small.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    ).mapInArrow(_counted, _LINE)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    blocks = blocks.withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    starts = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))
    blocks = write_stage(blocks.withColumn("first", F.coalesce(F.sum(starts).over(before), F.lit(0))).select(
        "file", "block", "parity", "first"), name="blocks")

    outside = F.col("parity") == 0
    placed = lines.join(blocks, ["file", "block"]).select(
        "file", "block", "line", "value",
        (F.col("first") + F.when(outside, F.col("even")).otherwise(F.col("odd"))).alias("number"),
        ((F.col("inside") + F.col("parity")) % 2 == 0).alias("starts"), (F.col("quotes") % 2 == 0).alias("closed"))
    alone = F.col("starts") & F.col("closed")
    parts = placed.filter(~alone)
    lost = write_stage(parts.groupBy("file", "number").count().filter(F.col("count") > max_lines).drop("count"), name="lost")
    joined = parts.join(lost, ["file", "number"], "left_anti").groupBy("file", "number").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).getField("value"), "\n").alias("record"))
    single = placed.filter(alone).unionByName(parts.join(lost, ["file", "number"], "left_semi").select(placed.columns))
    records = single.select("file", "number", F.col("value").alias("record")).unionByName(joined)
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")


def parsed_records(
    records: DataFrame, schema: T.StructType, header: bool = True, corrupt: str | None = None
) -> DataFrame:
    """Records as typed rows, columns by position; ``corrupt`` names the column of the schema that takes bad ones."""
    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"escape": QUOTE, **({"columnNameOfCorruptRecord": corrupt} if corrupt else {})}
    rows = records.filter("number > 1") if header else records
    return rows.select(F.explode(F.array(F.from_csv("record", named, options))).alias("r")).select("r.*")
