"""Substring dedup: sparse suffix trees over prefix partitions.

A passage counts when ``WINDOW`` words repeat. Suffixes are taken at anchors only: in each window the word gram with
the least hash. Equal windows have the same anchor at the same place, so suffixes that start at anchors, with the words
before them, show every repeat, at about a ninth of the positions. Anchors whose gram is alone in the corpus go first,
before any words are shuffled.

The remaining suffixes are dealt by prefix. A prefix is the anchor's gram; where more suffixes share it than a task
should hold, it is lengthened to the window, which is deep enough that only its first place matters. In a group
the suffixes are sorted, which is the leaf order of the subtree, and neighbours' common prefixes give its internal
nodes: a window with its anchor ``k`` words in repeats where leaves below a node of depth ``WINDOW - k`` agree in the
``k`` words before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.llm.common import column, give_back, giving_back, stage

WINDOW = 20
GRAM = 5
# Suffixes sorted in one task, and beyond which a prefix is lengthened.
BIN_ROWS = 50_000
PREFIX_ROWS = 100_000
# Words remembered while hashing; the memory forgets all when it is full.
WORDS_KEPT = 120_000
WORD_BYTES = 6
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word, computed once while remembered; never 0 in its lower 48 bits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) | 1
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words."""
    size = max(0, len(words) - length + 1)
    total = words[:size].copy()
    for k in range(1, length):
        total *= MIX
        total += words[k:k + size]
    return mixed(total)


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbours, the first if there are several."""
    place = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = values[:len(values) - step], values[step:]
        place = np.where(left <= right, place[:len(left)], place[step:])
        values = np.minimum(left, right)
        done += step
    return place


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place of each anchor, hash of its gram, and the first and last window that have it."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none.astype(np.uint64), none, none
    grams = run_hashes(words, gram)
    place = least_places(grams, window - gram + 1)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[first], grams[place[first]], first, np.r_[first[1:] - 1, len(place) - 1]


def hashed_words(text: bytes, seen: WordHashes) -> tuple[list[bytes], np.ndarray]:
    words = text.split()
    return words, np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def packed(place, before, run):
    """An anchor as one number; the lowest bit is free for a mark."""
    return place << 17 | before << 9 | run << 1


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places, the first and the last window at each, and the marks."""
    place, mark = codes >> 17, (codes & 1).astype(bool)
    lo = place - (codes >> 9 & 255)
    return place, lo, lo + (codes >> 1 & 255), mark


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Each row's numbers; none for a null."""
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[i:j] for i, j in zip(at[:-1], at[1:]))


def _batch(fields: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in fields.values()], list(fields))


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            docs, places, grams = [], [], []
            for doc, text in zip(batch.column("doc_no").to_numpy(), batch.column("text").to_pylist()):
                place, hashes, lo, hi = anchors(hashed_words(text, seen)[1], window, gram)
                docs.append(np.full(len(place), doc))
                places.append(packed(place, place - lo, hi - lo))
                grams.append(hashes)
            if docs:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(docs)),
                    pa.array(np.concatenate(places))], ["gram", "doc_no", "anchor"])

    return run


def _suffix_rows(window: int, gram: int):
    """Suffixes at shared anchors, one per content and batch; those of lengthened prefixes by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            least: dict[tuple, tuple] = {}
            for doc, text, shared in zip(
                    batch.column("doc_no").to_pylist(), batch.column("text").to_pylist(),
                    _lists(batch.column("shared"))):
                if not len(shared):
                    continue
                _, words = hashed_words(text, seen)
                places, lows, highs, long = unpacked(np.sort(shared))
                grams = run_hashes(words, gram)[places].view(np.int64)
                whole = run_hashes(words, window).view(np.int64) if long.any() else None
                narrow = np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
                for place, key, lo, hi, by_window in zip(*(x.tolist() for x in (places, grams, lows, highs, long))):
                    if by_window:
                        found = [((key, at, b""), (doc, start)) for start, at in enumerate(
                            whole[lo:hi + 1].tolist(), lo)]
                    else:
                        words_here = narrow[lo * WORD_BYTES:(hi + window) * WORD_BYTES]
                        found = [((key, place - lo, words_here), (doc, place))]
                    for content, where in found:
                        if content not in least or where < least[content]:
                            least[content] = where
            keys, wheres = list(least), list(least.values())
            yield _batch({
                "gram": ([k[0] for k in keys], pa.int64()),
                "before": ([k[1] for k in keys], pa.int64()),
                "words": ([k[2] for k in keys], pa.binary()),
                "doc_no": ([w[0] for w in wheres], pa.int64()),
                "place": ([w[1] for w in wheres], pa.int64()),
            })

    return run


def subtree_firsts(
    words: list[bytes], before: np.ndarray, doc: np.ndarray, place: np.ndarray, window: int, gram: int,
) -> np.ndarray:
    """Bit k of a suffix: its window that has the anchor k words in starts nowhere earlier in the group."""
    most, n = window - gram, len(words)
    table = np.zeros((n, most + window), np.uint64)
    narrow = table.view(np.uint8).reshape(n, most + window, 8)
    size = np.array([len(w) // WORD_BYTES for w in words])
    for i, w in enumerate(words):
        narrow[i, most - before[i]:most - before[i] + size[i], :WORD_BYTES] = np.frombuffer(w, np.uint8).reshape(
            -1, WORD_BYTES)
    right = np.ascontiguousarray(table[:, most:].astype(">u8")).view(f"S{8 * window}").ravel()
    order = np.argsort(right, kind="stable")
    table, before, size, doc, place = table[order], before[order], size[order], doc[order], place[order]
    same = table[1:, most:] == table[:-1, most:]
    common = np.where(same.all(axis=1), window, same.argmin(axis=1))
    firsts = np.zeros(n, np.int64)
    left = np.zeros(n, np.uint64)
    for k in range(most + 1):
        if k:
            left = mixed(left + table[:, most - k])
        node = np.r_[0, np.cumsum(common < window - k)]
        has = np.flatnonzero((k <= before) & (size - before >= window - k))
        has = has[np.lexsort((place[has], doc[has], left[has], node[has]))]
        new = np.r_[True, (node[has][1:] != node[has][:-1]) | (left[has][1:] != left[has][:-1])][:len(has)]
        firsts[has[new]] |= 1 << k
    back = np.empty(n, np.int64)
    back[order] = firsts
    return back


def _firsts_of_bin(window: int, gram: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        doc, place = rows["doc_no"].to_numpy(), rows["place"].to_numpy()
        bits = subtree_firsts(rows["words"].tolist(), rows["before"].to_numpy(), doc, place, window, gram)
        give_back()
        return pd.DataFrame({"doc_no": doc, "first": place << 32 | bits})[bits != 0]

    return run


def _cut_rows(window: int, gram: int, passed: list[str], keep_layout: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_words": [], "n_removed": [], "spans": [], "kept_text": []}
            for text, shared, firsts in zip(
                    batch.column("text").to_pylist(), _lists(batch.column("shared")), _lists(batch.column("firsts"))):
                words = text.split()
                cut, edges = 0, []
                if len(shared):
                    _, lo, hi, _ = unpacked(shared)
                    size = len(words) + 1
                    starts = np.cumsum(np.bincount(lo, minlength=size) - np.bincount(hi + 1, minlength=size)) > 0
                    place, bits = firsts >> 32, firsts & 0xFFFFFFFF
                    starts[place[bits == 0]] = False
                    for k in range(window - gram + 1):
                        starts[place[bits >> k & 1 == 1] - k] = False
                    at = np.flatnonzero(starts)
                    if len(at):
                        gone = np.cumsum(
                            np.bincount(at, minlength=size) - np.bincount(at + window, minlength=size))[:-1] > 0
                        edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                        edges = edges.reshape(-1, 2).tolist()
                        cut = int(gone.sum())
                out["n_words"].append(len(words))
                out["n_removed"].append(cut)
                out["spans"].append(edges)
                for start, stop in reversed(edges):
                    del words[start:stop]
                out["kept_text"].append((text if keep_layout and not cut else b" ".join(words)).decode())
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in passed],
                pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                pa.array(out["spans"], pa.list_(pa.list_(pa.int64()))), pa.array(out["kept_text"], pa.string()),
            ], [*passed, "n_words", "n_removed", "spans", "kept_text"])

    return run


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text, ...) with doc_no, one number per document in the order of ids.

    Where ids are unique, they are the numbers. Otherwise rows that repeat an id are told apart by their text, in
    the order of its hash, nulls first; rows that repeat both are one document.
    """
    n, ids = rows.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n == ids:
        return rows.withColumn("doc_no", F.col("doc_id"))
    keyed = rows.withColumn("content", F.xxhash64("text")).dropDuplicates(["doc_id", "content"])
    numbers = stage(
        keyed.select("doc_id", "content").orderBy(F.asc_nulls_first("doc_id"), "content")
        .withColumn("doc_no", F.monotonically_increasing_id()), "document-numbers").toDF("n_id", "n_content", "doc_no")
    return stage(keyed.join(
        numbers, keyed["doc_id"].eqNullSafe(F.col("n_id")) & (keyed["content"] == F.col("n_content"))
    ).select("doc_no", *rows.columns), "numbered-documents")


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
    bin_rows: int = BIN_ROWS, prefix_rows: int = PREFIX_ROWS, carry: list[str] | None = None,
    keep_layout: bool = False,
) -> DataFrame:
    """One row per document: doc_no, doc_id, n_words, n_removed, spans, kept_text.

    Words covered by a window whose words also start earlier (smaller doc_id, or the same document further left) are
    removed; ``spans`` lists them as [from, to) in words, joined where they touch: the maximal repeats. ``kept_text``
    has the other words, joined by one space; with ``keep_layout`` a text that loses nothing stays as it is. Windows
    are judged on the input. Documents shorter than a window lose nothing. Columns named in ``carry`` come along
    as the fields of ``carried``, where their names clash with none.

    Null text has no words. Rows that repeat an id count as one document if their texts are equal, else as several in
    the order of a hash of the text; a null id comes first. An empty table gives an empty result; other columns are
    not read. Words are compared by 48 bits of a hash, grams by 64 bits.
    """
    if not gram <= window <= gram + 31:
        raise ValueError("a window has between its gram and 31 words more")
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        *([F.struct(*[column(c) for c in carry]).alias("carried")] if carry else []))
    passed = ["doc_no", *[c for c in rows.columns if c != "text"]]
    rows = ordered(rows)
    found = rows.select("doc_no", "text").mapInArrow(
        giving_back(_anchor_rows(window, gram)), "gram long, doc_no long, anchor long")
    shared = stage(
        found.select("gram").groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "shared-grams")
    total, most = shared.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    places = stage(
        found.join(shared, "gram").groupBy("doc_no").agg(F.collect_list(
            F.col("anchor") + F.when(F.col("n") > prefix_rows, 1).otherwise(0)).alias("shared")), "shared-places")

    # Both uses below have the same shuffle of the texts; Spark runs it once.
    read = rows.join(places, "doc_no", "left").select(*passed, "text", "shared")
    suffixes = read.mapInArrow(
        giving_back(_suffix_rows(window, gram)), "gram long, before long, words binary, doc_no long, place long")
    bins = max(1, -(-total // bin_rows))
    firsts = suffixes.filter(F.length("words") > 0).groupBy(
        F.pmod(F.xxhash64("gram"), F.lit(bins)).alias("bin")
    ).applyInPandas(_firsts_of_bin(window, gram), "doc_no long, first long")
    if most > prefix_rows:
        by_window = suffixes.filter(F.length("words") == 0).groupBy("gram", "before").agg(
            F.min(F.struct("doc_no", "place")).alias("least"))
        firsts = firsts.unionByName(
            by_window.select("least.doc_no", F.shiftleft("least.place", 32).alias("first")))
    firsts = firsts.groupBy("doc_no").agg(F.collect_list("first").alias("firsts"))
    cut = read.join(firsts, "doc_no", "left").select(*passed, "text", "shared", "firsts")
    schema = T.StructType([
        *[cut.schema[c] for c in passed], T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("kept_text", T.StringType())])
    return cut.mapInArrow(giving_back(_cut_rows(window, gram, passed, keep_layout)), schema)
