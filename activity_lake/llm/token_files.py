"""Token ids as bit-packed shards with block offsets.

A shard is one byte string, little-endian: magic, bits per id, ids per block, documents, ids, blocks; then the document
ids, where each document's ids begin, where each block's bytes begin; then the blocks. A block packs its ids in ``bits``
bits each, lowest bit first, and ends at a whole byte, so any block can be read alone. Shards are rows of a Parquet
table, written by Spark's commit protocol to wherever Spark can write.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import calcsize, pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from activity_lake.llm.common import id_and_text, stage
from activity_lake.llm.tokens import encoder

MAGIC = b"TOKBITS1"
HEAD = "<8sIIQQQ"
BLOCK_IDS = 4096
SHARD_IDS = 1 << 18
SHARD_FIELDS = "part int, shard long, ids_before long, n_ids long, body binary"


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest bit first, filled up to a whole byte."""
    narrow = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return narrow[:, :bits // 8].tobytes()
    return np.packbits(np.unpackbits(narrow, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack_ids(body: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of what ``pack_ids`` gave."""
    wide = np.zeros((n, 4), np.uint8)
    if bits % 8 == 0:
        wide[:, :bits // 8] = np.frombuffer(body, np.uint8, n * bits // 8).reshape(n, -1)
    else:
        loose = np.unpackbits(np.frombuffer(body, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
        packed = np.packbits(loose, axis=1, bitorder="little")
        wide[:, :packed.shape[1]] = packed
    return wide.view("<u4").ravel()


def write_shard(docs: list[int | None], ids: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """A shard of documents in the given order; a missing document id is written as the least integer."""
    every = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    if len(every) and int(every.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack_ids(every[i:i + block_ids], bits) for i in range(0, len(every), block_ids)]
    names = np.array([np.iinfo(np.int64).min if d is None else d for d in docs], "<i8")
    return b"".join([
        pack(HEAD, MAGIC, bits, block_ids, len(docs), len(every), len(blocks)),
        names.tobytes(),
        np.cumsum([0, *map(len, ids)]).astype("<u8").tobytes(),
        np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes(),
        *blocks,
    ])


class Shard:
    """Random access to a shard's documents and ids."""

    def __init__(self, body: bytes):
        magic, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks = unpack_from(HEAD, body)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = calcsize(HEAD)
        self.docs = np.frombuffer(body, "<i8", n_docs, at)
        self.starts = np.frombuffer(body, "<u8", n_docs + 1, at := at + 8 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(body, "<u8", n_blocks + 1, at := at + 8 * (n_docs + 1)).astype(np.int64)
        self.blocks, self.body = at + 8 * (n_blocks + 1), body

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        read = [
            unpack_ids(
                self.body[self.blocks + self.offsets[b]:self.blocks + self.offsets[b + 1]], self.bits,
                min(self.block_ids, self.n_ids - b * self.block_ids))
            for b in range(first, last + 1)
        ]
        return np.concatenate(read)[start - first * self.block_ids:stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def _write_rows(tokenizer: str, end_id: int, shard_ids: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bits = encoder(tokenizer).encode, encoder(tokenizer).id_bits
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        docs, ids, n = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([shard], pa.int64()), pa.array([before], pa.int64()),
                pa.array([n], pa.int64()), pa.array([write_shard(docs, ids, bits, block_ids)], pa.binary()),
            ], ["part", "shard", "ids_before", "n_ids", "body"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                docs.append(doc)
                ids.append(np.frombuffer(encode(text.as_py()) + end, "<u4"))
                n += len(ids[-1])
                if n >= shard_ids:
                    yield row()
                    shard, before = shard + 1, before + n
                    docs, ids, n = [], [], 0
        if docs:
            yield row()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_ids: int = SHARD_IDS, block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every whole text, end it with ``end_id`` and write shards in ascending order of ids to ``path``.

    Null text is empty: just the end. Null ids come first. Rows that repeat an id are written each, in the order of a
    hash of their text. An empty table writes no shard. A task writes shards of ``shard_ids`` ids, more only where one
    document has more.
    """
    rows = id_and_text(docs, id_col, text_col)
    rows.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).mapInArrow(
        _write_rows(tokenizer, end_id, shard_ids, block_ids), SHARD_FIELDS,
    ).write.option("compression", "none").parquet(path)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, body in zip(batch.column("before").to_pylist(), batch.column("body")):
            shard = Shard(body.as_py())
            every = shard.ids(0, shard.n_ids).tobytes()
            ids = [every[4 * i:4 * j] for i, j in zip(shard.starts[:-1], shard.starts[1:])]
            missing = shard.docs == np.iinfo(np.int64).min
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.docs, mask=missing), pa.array(shard.starts[:-1] + before),
                pa.array(np.diff(shard.starts)), pa.array(ids, pa.binary()),
            ], ["doc_id", "start", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; ids are little-endian unsigned 32-bit bytes.

    A document without an id has a null one; an empty folder gives no rows. The files have no other columns.
    """
    shards = spark.read.schema(SHARD_FIELDS).parquet(path)
    # One row per write task is what is summed here; as a written table it is known to be small, and shards stay put.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = stage(parts.select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("part_before")), "token-parts")
    return shards.join(parts, "part").select(
        (F.col("part_before") + F.col("ids_before")).alias("before"), "body",
    ).mapInArrow(_read_rows, "doc_id long, start long, n_tokens long, ids binary")
