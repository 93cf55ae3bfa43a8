"""Packing into sequences: a configuration linear program over the lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from activity_lake.llm.common import giving_back, id_and_text, stage
from activity_lake.llm.tokens import PIECES_KEPT, encoder

CAPACITY = 4096
# The program is solved and rounded in rounds; each has this many pricings.
ROUNDS = 6
PRICINGS = 20
STEP = 0.5
# Configurations taken from one pricing table, and how much less than the best they may be worth.
SEVERAL = 200
SLACK = 0.003
# Pieces of one length that are numbered in one group.
RANK_ROWS = 50_000


def _cut_pieces(tokenizer: str, end_id: int, capacity: int, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, kept).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text", kept: int = PIECES_KEPT,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): ids of each whole text and its end, cut every ``capacity`` ids."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        giving_back(_cut_pieces(tokenizer, end_id, capacity, kept)),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def dearest(
    sizes: np.ndarray, worth: np.ndarray, most: np.ndarray, capacity: int, several: int = SEVERAL,
) -> list[dict[int, int]]:
    """Configurations (place in ``sizes`` -> how often) of most worth, by knapsack dynamic programming.

    One table prices them all: the first is the best that fits, the next ones the best without the lengths taken
    before, as long as they lose no more than ``SLACK`` of the best worth.
    """
    best = np.zeros(capacity + 1)
    ends = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for room in range(int(sizes[0]), capacity + 1):
        best[room] = max(best[room - 1], (best[room - sizes[:ends[room]]] + worth[:ends[room]]).max())
    configs: list[dict[int, int]] = []
    free = np.ones(len(sizes), bool)
    while len(configs) < several and free.any():
        config: dict[int, int] = {}
        room, gained, open_sizes = capacity, 0.0, free.copy()
        while True:
            at = np.flatnonzero(open_sizes[:ends[room]])
            if not len(at):
                break
            k = int(at[(best[room - sizes[at]] + worth[at]).argmax()])
            config[k] = config.get(k, 0) + 1
            open_sizes[k] = config[k] < most[k]
            room, gained = room - int(sizes[k]), gained + worth[k]
        if not config or configs and gained < (1 - SLACK) * best[capacity]:
            break
        free[list(config)] = False
        configs.append(config)
    return configs


def solve_fractional(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, pricings: int,
) -> list[tuple[float, dict[int, int]]]:
    """Configurations and how often to use each, from multiplicative weights.

    A length's weight is the price of one item; it starts at its share of a sequence, which is the dual solution of a
    waste-free packing, and falls with the part of its items that is covered. Each pricing finds the configurations
    of most worth, and uses each until a part ``STEP`` of its scarcest length is covered.
    """
    price = sizes / capacity
    chosen: list[tuple[float, dict[int, int]]] = []
    for _ in range(pricings):
        for config in dearest(sizes, price, counts, capacity):
            at = np.fromiter(config, np.int64, len(config))
            times = np.fromiter(config.values(), np.float64, len(config))
            uses = STEP * (counts[at] / times).min()
            chosen.append((uses, config))
            price[at] *= np.exp(-STEP * uses * times / counts[at])
    return chosen


def pack_rest(
    sizes: list[int], counts: dict[int, int], capacity: int, plan: list[tuple[int, dict[int, int]]],
) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, of what rounding leaves, into the free room of the plan and then into new sequences.

    Equal sequences are handled together, so that the work depends on the number of lengths and configurations.
    """
    by_room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms: list[int] = []

    def put(copies: int, config: dict[int, int], room: int) -> None:
        if copies:
            if room not in by_room:
                insort(rooms, room)
            by_room.setdefault(room, []).append((copies, config))

    for copies, config in plan:
        put(copies, config, capacity - sum(s * k for s, k in config.items()))
    for size in sorted(sizes, reverse=True):
        n = counts[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                copies, config = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[i]
            else:
                room, copies, config = capacity, n, {}
            each = min(room // size, n)
            used = min(copies, n // each)
            put(used, {**config, size: config.get(size, 0) + each}, room - each * size)
            if config:
                put(copies - used, config, room)
            n -= used * each
    return [row for rows in by_room.values() for row in rows]


def plan_sequences(
    lengths: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, pricings: int = PRICINGS,
) -> list[tuple[int, dict[int, int]]]:
    """(copies, {length: items}) that use exactly the given counts of lengths, in as few sequences as it can.

    Each round solves the program for what is left, rounds the uses down and takes them off the counts; uses that the
    counts no longer bear are lowered. What rounding leaves over goes, longest first, into the fullest sequences with
    room. The work depends on the lengths that occur, not on how many pieces have them.
    """
    left = dict(lengths)
    plan: list[tuple[int, dict[int, int]]] = []
    if left.get(capacity):
        plan.append((left.pop(capacity), {capacity: 1}))
    for _ in range(rounds):
        left = {size: n for size, n in left.items() if n}
        if not left:
            break
        sizes = np.array(sorted(left), np.int64)
        counts = np.array([left[s] for s in sizes.tolist()], np.float64)
        for uses, config in solve_fractional(sizes, counts, capacity, pricings):
            config = {int(sizes[i]): k for i, k in config.items()}
            copies = min([int(uses), *(left[s] // k for s, k in config.items())])
            if copies:
                plan.append((copies, config))
                for s, k in config.items():
                    left[s] -= copies * k
    return pack_rest([size for size, n in left.items() if n], left, capacity, plan)


def slots(plan: list[tuple[int, dict[int, int]]]) -> pd.DataFrame:
    """Where the items of a length go, by their rank among their length: runs that start at ``first``."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for copies, config in plan:
        offset = 0
        for size in sorted(config, reverse=True):
            each = config[size]
            rows.append((size, used.get(size, 0), each, sequence, offset))
            used[size] = used.get(size, 0) + copies * each
            offset += each * size
        sequence += copies
    return pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"]).sort_values(
        ["length", "first"], ignore_index=True)


def ranked(pieces: DataFrame, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Pieces with their rank among those of their length.

    A length with many pieces is numbered in groups of about ``rank_rows``, told apart by a hash, after the pieces of
    the groups before.
    """
    counts = pieces.groupBy("length").agg(F.ceil(F.count("*") / rank_rows).alias("groups"))
    grouped = stage(pieces.join(counts, "length").withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("groups"))).drop("groups"), "piece-groups")
    sizes = grouped.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = sizes.select("length", "group", (
        F.sum("n").over(W.partitionBy("length").orderBy("group")) - F.col("n")).alias("before"))
    number = F.row_number().over(W.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32"))
    return grouped.withColumn("number", number).join(before, ["length", "group"]).withColumn(
        "rank", F.col("before") + F.col("number") - 1).drop("group", "number", "before")


def _place(table: pd.DataFrame):
    length, first, each, sequence, offset = (table[c].to_numpy() for c in table.columns)
    key = (length << 44) + first

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rank, size = rows["rank"].to_numpy(), rows["length"].to_numpy()
            at = np.searchsorted(key, (size << 44) + rank, "right") - 1
            nth = rank - first[at]
            yield rows.assign(
                sequence_id=sequence[at] + nth // each[at], offset=offset[at] + nth % each[at] * size,
            ).drop(columns="rank")

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset; offsets of a sequence are gapless from 0.

    Only the histogram of lengths, at most ``capacity`` rows, reaches the driver; the plan that goes back is bounded
    by the number of configurations. Repeated rows are pieces of their own; an empty table gives an empty result.
    """
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    return ranked(pieces).mapInPandas(
        _place(slots(plan_sequences(lengths, capacity))),
        "length long, doc_id long, piece int, start long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text", kept: int = PIECES_KEPT,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of each document.

    Null text is empty: a piece with just the end id. Null and repeated ids are kept as they are, one document per row;
    other columns are not read. A worker remembers the ids of ``kept`` chunks of text at most.
    """
    pieces = stage(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, kept), "pieces")
    return pack_pieces(pieces, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
