"""Toxicity: a linear classifier from confirmed toxic texts and unlabelled ones."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import column, giving_back, id_and_text, stage

# Bounds of the training sample, in documents.
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
BUCKETS = 1 << 20
# Sizes of the byte runs that are features beside whole words.
RUNS = (5, 7)
# A feature enters the model when so many confirmed texts have it, and their share is so many times that of the
# unlabelled ones and so many standard errors above it.
MIN_TEXTS = 5
MIN_LIFT = 2.0
MIN_ERRORS = 4.0
STEPS = 500
RATE = 0.02
SHRINK = 0.0005
# Words remembered by a task: with the places of all their runs, and with the known ones, mostly none.
WORDS_COUNTED = 100_000
WORDS_KEPT = 400_000

# Letters of ASCII in lower case and all bytes beyond it stay; the rest parts words.
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def held_out(id_column: Column) -> Column:
    """Rows that are never learned from; a null id is not among them."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def runs(word: bytes) -> set[bytes]:
    """The word and the byte runs in it, its ends marked."""
    marked = b"^" + word + b"$"
    return {marked, *(marked[i:i + n] for n in RUNS for i in range(len(marked) - n + 1))}


class Known(dict):
    """Places of a word's runs among known buckets; all buckets are known if none are given."""

    def __init__(self, buckets: np.ndarray | None = None):
        super().__init__()
        self.kept = WORDS_COUNTED if buckets is None else WORDS_KEPT
        self.place = None if buckets is None else {int(b): i for i, b in enumerate(buckets)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.kept:
            self.clear()
        found = [xxhash.xxh32_intdigest(r) % BUCKETS for r in runs(word)]
        if self.place is not None:
            found = [self.place[b] for b in found if b in self.place]
        value = self[word] = tuple(found)
        return value


def features(text: bytes, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """The text's known features and their strength, the logarithm of 1 + how often each occurs."""
    times: dict[int, int] = {}
    for word, n in Counter(text.translate(KEPT).split()).items():
        for at in known[word]:
            times[at] = times.get(at, 0) + n
    return np.fromiter(times, np.int64, len(times)), np.log2(1 + np.fromiter(times.values(), float, len(times)))


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, confirmed, others): in how many of a task's texts each feature is."""
    known, n = Known(), np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for positive, text in zip(batch.column("positive").to_pylist(), batch.column("text").to_pylist()):
            n[0 if positive else 1][features(text, known)[0]] += 1
    some = np.flatnonzero(n.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(n[0][some]), pa.array(n[1][some])], ["bucket", "confirmed", "others"])


def _strengths(buckets: np.ndarray):
    """(positive, at, strength): the known features of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(buckets)
        for batch in batches:
            found = [features(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))], ["positive", "at", "strength"])

    return run


@dataclass(frozen=True)
class Classifier:
    """Score of a text: the logistic function of the bias and the weighted strengths of its features."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def logistic(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_nnpu(
    n: int, positive: list[tuple], unlabelled: list[tuple], prior: float, steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights of ``n`` features and a bias that minimise the non-negative positive-unlabelled risk.

    Texts are (features, strengths). The risk of negatives is that of unlabelled texts as negatives, less the prior
    times that of positives as negatives. Where a step's estimate of it falls below zero, which only overfitting
    does, the step goes back up on that part instead of down. Weights shrink towards zero.
    """
    def rows(texts):
        at, strength = (np.concatenate([np.zeros(0), *x]) for x in zip(*texts))
        return at.astype(np.int64), strength, np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts]), len(texts)

    sides = rows(positive), rows(unlabelled)
    w, mean, square = np.zeros((3, n + 1))
    w[n] = np.log(prior / (1 - prior))

    def score(side):
        at, strength, row, size = side
        return w[n] + np.bincount(row, w[at] * strength, size)

    def gradient(side, each):
        at, strength, row, size = side
        return np.append(np.bincount(at, each[row] * strength, n), each.sum()) / size

    for step in range(1, steps + 1):
        z_p, z_u = score(sides[0]), score(sides[1])
        as_negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        down = gradient(sides[1], logistic(z_u)) - prior * gradient(sides[0], logistic(z_p))
        up = prior * gradient(sides[0], -logistic(-z_p))
        g = up + down if as_negative >= 0 else -down
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        w -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        w[:n] = np.sign(w[:n]) * np.maximum(np.abs(w[:n]) - SHRINK, 0)
    return w[:n], float(w[n])


def train_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
) -> Classifier:
    """Fit on texts that ``labels`` (doc_id, toxic) confirms as toxic and on texts taken without their labels.

    Rows that ``held_out`` marks are not read. At most ``max_positive`` and ``max_unlabelled`` documents, taken in the
    order of a hash of their id, train the model, each by its whole text; equal texts count once. The class prior is the
    share of toxic among all labelled documents; a document is toxic if any of its labels says so. Features that confirmed
    texts do not have clearly more often are left out, so that a long text is not judged by many weak ones; only the
    others reach the driver. With no confirmed or no unlabelled texts every score is 0.
    """
    rows = id_and_text(docs, id_col, text_col).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = labels.select(column(id_col).cast("long").alias("doc_id"), column("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    marks = stage(marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    order = [F.xxhash64("doc_id"), "doc_id"]
    positive = marks.filter("toxic = 1").select("doc_id").join(
        rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(*order).limit(max_positive)
    unlabelled = rows.select("doc_id").distinct().orderBy(*order).limit(max_unlabelled)
    wanted = stage(
        positive.withColumn("positive", F.lit(True)).unionByName(unlabelled.withColumn("positive", F.lit(False))),
        "toxicity-sample")
    sample = stage(
        rows.join(wanted, "doc_id").select("positive", F.col("text").cast("binary").alias("text")).distinct(),
        "toxicity-texts")
    n_p, n_u = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p or not n_u:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    counts = sample.mapInArrow(giving_back(_texts_with), "bucket long, confirmed long, others long").groupBy("bucket").agg(
        F.sum("confirmed").alias("p"), F.sum("others").alias("u"))
    p, u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    error = F.sqrt(p * (1 - p) / n_p + u * (1 - u) / n_u)
    clear = counts.filter((F.col("p") >= MIN_TEXTS) & (p >= MIN_LIFT * u) & (p - u >= MIN_ERRORS * error))
    known = np.sort(clear.select("bucket").toArrow()["bucket"].to_numpy())
    found = sample.mapInArrow(giving_back(_strengths(known)), "positive boolean, at array<long>, strength array<double>").toArrow()
    texts = {True: [], False: []}
    for flag, at, strength in zip(found["positive"].to_pylist(), found["at"], found["strength"]):
        texts[flag].append((at.values.to_numpy(), strength.values.to_numpy()))
    weights, bias = fit_nnpu(len(known), texts[True], texts[False], min(max(share or 0.0, 0.001), 0.5))
    return Classifier(known, weights, bias)


def scorer(model: Classifier):
    known = Known(model.buckets)

    def score(texts: Iterable[bytes]) -> np.ndarray:
        z = []
        for text in texts:
            at, strength = features(text, known)
            z.append(model.bias + model.weights[at] @ strength)
        return logistic(np.array(z, float))

    return score


def _score(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score(batch.column("text").to_pylist()))], ["doc_id", "score"])

    return run


def score_toxicity(
    docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold) of each row's whole text.

    Null and empty texts get the score of the bias alone. Rows are scored one by one: repeated rows alike, an empty
    table gives an empty result; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        giving_back(_score(model)), "doc_id long, score double",
    ).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
             (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Classifier, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose whole text scores below ``threshold``; null text is empty.

    Rows are judged one by one, repeated ones alike; the text is found by its place, so other names do not matter.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(score((t or "").encode() for t in batch.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(giving_back(run), docs.schema)
