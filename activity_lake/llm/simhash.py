"""SimHash near-dedup; links are found by chains of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import bins_of, id_and_text, stage
from activity_lake.llm.graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SEGMENTS = 8
# Budget of the first 1, 2, ... segments of a chain: its share of MAX_BITS.
BUDGETS = np.array([(k + 1) * MAX_BITS // SEGMENTS for k in range(SEGMENTS)], np.uint8)
# Rows compared at a time, and the largest bucket that is compared without being split.
BIN_ROWS = 50_000
BUCKET_ROWS = 2_000
# So few open bits bound a bucket by 2 ** 14 fingerprints.
LEAST_OPEN_BITS = 14
ALL = (1 << 64) - 1


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of 64 bits."""
    bits = np.unpackbits(np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    """The 64 bits that more than half of ``n`` hashes have."""
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes) -> int:
    """64 bits; a bit is set when more than half of the shingles' hashes have it. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)])))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = shingles[at:at + (1 << 16)]
        counts += bit_counts(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), "<u8", len(part)))
    return majority(counts, len(shingles))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter(map(fingerprint, batch.column("text").to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per input row; whole texts, null as empty."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _fingerprints, "doc_id long, fp long")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def chain_masks() -> list[tuple[int, int]]:
    """(start, mask) of the parts that two linked fingerprints must share for some start.

    Budgets of a chain are 0, 0, 1, 1, 1, 2, 2, 3: two segments agree, and of the next three at least two.
    """
    segment = lambda i: 255 << 8 * (i % SEGMENTS)
    return [
        (i, segment(i) | segment(i + 1) | segment(i + a) | segment(i + b))
        for i in range(SEGMENTS) for a, b in ((2, 3), (2, 4), (3, 4))
    ]


def finer_masks(mask: int) -> list[int]:
    """Masks that share one of four equal parts of the open bits more: three differing bits leave one part alike."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part) for part in (p.tolist() for p in np.array_split(rest, MAX_BITS + 1))]


def linked(differing: np.ndarray, start: int) -> np.ndarray:
    """Which of the XORed fingerprints are links, seen from ``start``: the chain first, then the whole distance."""
    good = np.zeros(len(differing), bool)
    segments = np.bitwise_count(differing.view(np.uint8).reshape(-1, SEGMENTS))
    chain = np.cumsum(np.roll(segments, -start, axis=1)[:, :-1], axis=1, dtype=np.uint8)
    left = np.flatnonzero((chain <= BUDGETS[:-1]).all(axis=1))
    good[left] = np.bitwise_count(differing[left]) <= MAX_BITS
    return good


def spanning(members: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that join what is linked within one bucket, one per member at most."""
    links, rest = [], members
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = linked(rest ^ at, start)
            links += [(at, x) for x in rest[near]]
            front += list(rest[near])
            rest = rest[~near]
    return links


def _links_of_bin(rows: pd.DataFrame) -> pd.DataFrame:
    fp, value, mask, start = (rows[c].to_numpy() for c in ("fp", "value", "mask", "start"))
    order = np.lexsort((fp, value, mask, start))
    fp, value, mask, start = fp[order].view(np.uint64), value[order], mask[order], start[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (mask[1:] != mask[:-1]) | (start[1:] != start[:-1])] if len(
        fp) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(fp)])
    found = []
    for s in np.unique(start):
        pairs = first[(size == 2) & (start[first] == s)]
        good = pairs[linked(fp[pairs] ^ fp[pairs + 1], s)]
        found.append(np.stack([fp[good], fp[good + 1]], axis=1))
    for at, n in zip(first[size > 2], size[size > 2]):
        found.append(np.array(spanning(fp[at:at + n], start[at]), np.uint64).reshape(-1, 2))
    both = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    both = np.ascontiguousarray(both).view(np.int64)
    return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]}).drop_duplicates()


def near_links(
    distinct: DataFrame, bucket_rows: int = BUCKET_ROWS, bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``distinct`` (fp) with at most three differing bits.

    A fingerprint is filed under 24 shared parts of 32 bits. Buckets are compared whole, many to a task, and give
    links that span them instead of all pairs. A bucket above ``bucket_rows`` is filed again under finer parts, which
    loses no link, until few open bits bound it. Finer parts of neighbouring starts coincide, and a link may be seen
    from one of them only, so that each start has buckets of its own.
    """
    filed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), F.lit(signed(m)).cast("long").alias("mask")) for i, m in chain_masks()
    ])).alias("m")).select("fp", "m.*")
    masks = dict.fromkeys(m for _, m in chain_masks())
    found = []
    while True:
        filed = filed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        bounded = 64 - min(map(int.bit_count, masks)) <= LEAST_OPEN_BITS
        full = None if bounded else stage(
            filed.groupBy("start", "mask", "value").agg(F.count("*").alias("n"))
            .filter(F.col("n") > bucket_rows).select("start", "mask", "value"), "full-buckets")
        last = bounded or full.isEmpty()
        ready = filed if last else filed.join(full, ["start", "mask", "value"], "left_anti")
        bins = bins_of(ready, bin_rows)
        found.append(stage(
            ready.groupBy(F.pmod(F.xxhash64("start", "mask", "value"), F.lit(bins)).alias("bin"))
            .applyInPandas(_links_of_bin, "a long, b long"), "near-links"))
        if last:
            return reduce(DataFrame.unionByName, found)
        finer = {m: finer_masks(m) for m in masks}
        masks = dict.fromkeys(x for parts in finer.values() for x in parts)
        table = distinct.sparkSession.createDataFrame(
            [(signed(m), [signed(x) for x in parts]) for m, parts in finer.items()], "mask long, finer array<long>")
        filed = filed.join(full, ["start", "mask", "value"], "left_semi").join(table, "mask").select(
            "fp", "start", F.explode("finer").alias("mask")).distinct()


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS, bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (least doc_id that links reach, its own included).

    Equal fingerprints are one node, however many documents have them; only distinct ones are compared. Texts without
    words, null among them, have fingerprint 0, which links like any other. A null doc_id is never a component_id,
    unless its component has no other id. Repeated rows give a row each; an empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = components(near_links(nodes.select("fp"), bucket_rows, bin_rows), "simhash-links")
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = stage(placed.join(named, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")
