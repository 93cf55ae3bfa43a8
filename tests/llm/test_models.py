import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_lake.llm import language, toxicity
from activity_lake.llm.common import documents
from tests.llm.helpers import ODD, table

SIZES = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SIZES)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SIZES}/labels.parquet")


@pytest.fixture(scope="module")
def languages(docs):
    return language.train_languages(docs, max_texts=100)


@pytest.fixture(scope="module")
def toxic(docs, labels):
    return toxicity.train_toxicity(docs, labels)


def test_held_out_languages(docs, languages):
    got = language.predict_language(docs, languages).join(docs.select("doc_id", "lang"), "doc_id").filter(
        "held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"))
    right, n = got.first()
    assert n > 1500 and right > 0.97


def plain_cost(counts, text):
    """Bits of a text by escape method C, byte by byte."""
    padded, bits = b" " * language.ORDER + text, 0.0
    for i in range(language.ORDER, len(padded)):
        for order in range(language.ORDER, -1, -1):
            seen = counts[order][padded[i - order:i]]
            n, q = sum(seen.values()), len(seen)
            if not n:
                continue
            if seen[padded[i:i + 1]]:
                bits -= math.log2(seen[padded[i:i + 1]] / (n + q))
                break
            bits -= math.log2(q / (n + q))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    samples = {"aa": b"the cat sat on the mat", "bb": b"der hund und die katze"}
    langs, grams, counts = [], [], []
    plain = {}
    for k, (name, text) in enumerate(samples.items()):
        padded = np.frombuffer(language.START + text, np.uint8)
        keys, n = np.unique(language.grams(padded), return_counts=True)
        langs += [k] * len(keys)
        grams.append(keys)
        counts.append(n)
        by_order = plain[name] = [dict() for _ in range(language.ORDER + 1)]
        by_order[:] = [__import__("collections").defaultdict(Counter) for _ in by_order]
        body = language.START + text
        for i in range(language.ORDER, len(body)):
            for order in range(language.ORDER + 1):
                by_order[order][body[i - order:i]][body[i:i + 1]] += 1
    model = language.ContextTrees(list(samples), np.array(langs), np.concatenate(grams), np.concatenate(counts))
    texts = [b"the hund", b"", b"katze on the mat", b"\xc3\xa9zz", b"x" * 50]
    got = model.code_lengths(texts)
    for row, text in zip(got, texts):
        assert np.allclose(row, [plain_cost(plain[n], text) for n in samples])


def test_odd_texts_have_a_defined_language(spark, languages):
    got = language.predict_language(table(spark, ODD), languages).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*languages.languages, "und"}
        assert r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 0)
    und = language.predict_language(table(spark, [(1, None), (2, ""), (3, "12 — !"), (4, "_")]), languages).collect()
    assert {r["lang_pred"] for r in und} == {"und"}
    empty = table(spark, ODD).limit(0)
    nothing = language.train_languages(empty)
    assert nothing.languages == [] and language.predict_language(empty, nothing).count() == 0
    assert {r["lang_pred"] for r in language.predict_language(table(spark, ODD), nothing).collect()} == {"und"}


def test_held_out_toxicity(docs, labels, toxic):
    got = toxicity.score_toxicity(docs, toxic).join(labels, "doc_id").filter("held_out").groupBy("toxic").agg(
        F.avg("predicted")).collect()
    flagged = dict(map(tuple, got))
    assert flagged[1] > 0.8 and flagged[0] < 0.04


def test_labels_of_held_out_rows_are_not_read(spark, docs, labels, toxic):
    turned = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.train_toxicity(docs, turned)
    assert np.array_equal(other.buckets, toxic.buckets) and np.allclose(other.weights, toxic.weights)


def test_scores_equal_a_plain_sum(spark, toxic):
    rows = [(1, "you IDIOT, you moron"), (2, "idiot idiot idiot"), (3, None), (4, ""), *[(9, t) for _, t in ODD]]
    got = [r["score"] for r in toxicity.score_toxicity(table(spark, rows).coalesce(1), toxic).collect()]
    weight = dict(zip(toxic.buckets.tolist(), toxic.weights.tolist()))
    for score, (_, text) in zip(got, rows):
        times = Counter()
        for word in (text or "").encode().translate(toxicity.KEPT).split():
            for run in toxicity.runs(word):
                times[toxicity.xxhash.xxh32_intdigest(run) % toxicity.BUCKETS] += 1
        z = toxic.bias + sum(weight.get(b, 0) * math.log2(1 + n) for b, n in times.items())
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-9
    assert got[0] > 0.5 > got[2] and got[2] == got[3]


def test_nothing_to_learn(spark):
    docs = table(spark, ODD)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, none)
    got = toxicity.score_toxicity(docs, model).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}
    assert toxicity.drop_toxic(docs, model).count() == len(ODD)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_risk_of_negatives_does_not_fall_below_zero():
    rng = np.random.default_rng(0)
    texts = lambda n, p: [(np.flatnonzero(f := rng.random(30) < p), np.ones(int(f.sum()))) for _ in range(n)]
    positive = texts(40, np.r_[0.9, np.full(29, 0.3)])
    unlabelled = texts(20, np.r_[0.9, np.full(29, 0.3)]) + texts(180, np.r_[0.0, np.full(29, 0.3)])
    weights, bias = toxicity.fit_nnpu(30, positive, unlabelled, 0.1, steps=2000)
    assert weights.argmax() == 0 and weights[0] + bias > 0 > bias
