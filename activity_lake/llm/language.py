"""Language ID by prediction by partial matching over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from activity_lake.llm.common import column, stage
from activity_lake.llm.toxicity import held_out

# The longest context, in bytes; a context and its byte fit one 32-bit number.
ORDER = 3
# Bound of the training sample, in documents per language.
MAX_TEXTS = 500
# How many times as many texts pass the bound on their hash that is set before they are ranked.
SPARE = 4
# Bytes scored at a time.
CHUNK_BYTES = 1 << 21

START = b" " * ORDER
LETTER = re.compile(r"[^\W\d_]")
# Of ASCII, letters stay; runs of the rest are one space, which carries the ends of words.
PLAIN = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain_bytes(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(PLAIN).split())


def grams(text: np.ndarray) -> np.ndarray:
    """Each byte with the ``ORDER`` bytes before it, as one number; ``text`` begins with that many bytes."""
    size = len(text) - ORDER
    total = np.zeros(size, np.uint32)
    for k in range(ORDER + 1):
        total = (total << np.uint32(8)) | text[k:k + size]
    return total


@dataclass(frozen=True)
class Order:
    """Frozen counts of one context length; a column per language."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    distinct: np.ndarray


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], 0)


class ContextTrees:
    """Per-language context trees; cost of a byte after its context in bits, exactly, as escape method C codes it.

    A byte seen after the longest context costs log2((n + q) / c), with c its count, n all counts and q the different
    bytes there. One not seen costs the escape, log2((n + q) / q), and is coded with the context one byte shorter;
    contexts never seen cost nothing. Below the empty context all 256 bytes are alike.
    """

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.languages = languages
        self.orders: list[Order] = []
        for order in range(ORDER, -1, -1):
            part = gram & np.uint32((1 << 8 * (order + 1)) - 1)
            keys, at = np.unique(part, return_inverse=True)
            counts = np.zeros((len(keys), len(languages)))
            np.add.at(counts, (at, language), count)
            contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
            totals, distinct = np.zeros((2, len(contexts), len(languages)))
            np.add.at(totals, of, counts)
            np.add.at(distinct, of, (counts > 0).astype(float))
            self.orders.append(Order(keys, counts, contexts, totals, distinct))

    def costs(self, wanted: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte, a column per language."""
        bits = np.zeros((len(wanted), len(self.languages)))
        open_ = np.ones(bits.shape, bool)
        for order, o in zip(range(ORDER, -1, -1), self.orders):
            part = wanted & np.uint32((1 << 8 * (order + 1)) - 1)
            seen = _find(o.grams, o.counts, part)
            n = _find(o.contexts, o.totals, part >> np.uint32(8))
            q = _find(o.contexts, o.distinct, part >> np.uint32(8))
            here = open_ & (n > 0)
            coded = here & (seen > 0)
            bits += np.where(here, np.log2(np.maximum(n + q, 1)) - np.log2(
                np.maximum(np.where(coded, seen, q), 1)), 0)
            open_ &= ~coded
        return bits + 8 * open_

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text by each language."""
        out = np.zeros((len(texts), len(self.languages)))
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK_BYTES):
                size += len(texts[last])
                last += 1
            joined = np.frombuffer(START + START.join(texts[first:last]), np.uint8)
            lengths = np.array([len(t) for t in texts[first:last]])
            starts = np.cumsum(np.r_[0, lengths[:-1] + ORDER])
            keys, at = np.unique(grams(joined), return_inverse=True)
            bits = self.costs(keys)
            for k in range(len(self.languages)):
                total = np.r_[0, np.cumsum(bits[:, k][at])]
                out[first:last, k] = total[starts + lengths] - total[starts]
            first = last
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            keys, n = np.unique(grams(np.frombuffer(START + plain_bytes(text), np.uint8)), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def train_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_texts: int = MAX_TEXTS,
) -> ContextTrees:
    """Count grams of at most ``max_texts`` whole texts per language, taken in the order of a hash of their id.

    Rows with a null id, text or language, and those that ``held_out`` marks, are not learned from. Without any row
    left no language is known.
    """
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"),
        column(lang_col).cast("string").alias("lang"),
    ).filter("doc_id is not null and text is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    ids = rows.select("doc_id", "lang").distinct()
    # The first in order of a hash lie below a bound on it that lets several times as many through as are wanted: what is
    # ranked does not grow with the rows of a language. As many counts come to the driver as the model has languages.
    bounds = [(r["lang"], (1 << 64) * SPARE * max_texts // r["count"] - (1 << 63)) for r in ids.groupBy("lang").count().collect()]
    first = F.lit(False)
    for lang, bound in bounds:
        first = first | ((F.col("lang") == lang) & (F.xxhash64("doc_id") <= min(bound, (1 << 63) - 1)))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    wanted = stage(
        ids.filter(first).withColumn("place", place)
        .filter(F.col("place") <= max_texts).drop("place"), "language-sample")
    sample = rows.join(wanted, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    counts = sample.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names, at = np.unique(np.array(counts["lang"].to_pylist(), object).astype(str), return_inverse=True)
    return ContextTrees(
        names.tolist(), at, counts["gram"].to_numpy().astype(np.uint32), counts["n"].to_numpy().astype(float))


def _predict(model: ContextTrees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            known = np.array([bool(model.languages) and LETTER.search(t) is not None for t in texts], bool)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if known.any():
                bits = model.code_lengths([plain_bytes(t) for t, k in zip(texts, known) if k])
                best[known] = bits.argmin(axis=1)
                with np.errstate(over="ignore"):
                    score[known] = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"])

    return run


def predict_language(
    docs: DataFrame, model: ContextTrees, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row's whole text.

    The language with the shortest code wins, of equal ones the first by name; the score is its share of the
    probabilities that the code lengths stand for. Texts that are null or have no letter, and all texts when no language
    was learned, are ``und`` with score 0. Rows are judged one by one; other columns are not read.
    """
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
