import math
import shutil
from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from activity_lake.llm.common import documents, stage
from activity_lake.llm.toxicity import KEPT, BUCKETS, runs, train_toxicity, xxhash
from tests.llm.helpers import ODD, fingerprint, first, normal, table, without_repeats, words
from tests.llm.test_near_copies import plain_groups
from tests.llm.test_tokens import ids_of

SIZES = "/root/testdata/sf0.01"
STEPS = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage is given and gives."""
    docs, out = documents(spark, SIZES), {}
    for name, apply in pipeline.STAGES:
        after = stage(apply(spark, docs, SIZES), name)
        out[name] = docs, after
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_toxic_documents_go(spark, steps):
    given, left = steps["toxicity"]
    model = train_toxicity(given, spark.read.parquet(f"{SIZES}/labels.parquet"))
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    expected = {}
    for doc, text in texts(given).items():
        times = Counter()
        for word in (text or "").encode().translate(KEPT).split():
            times.update(xxhash.xxh32_intdigest(r) % BUCKETS for r in runs(word))
        z = model.bias + sum(weight.get(b, 0) * math.log2(1 + n) for b, n in times.items())
        if z < 0:
            expected[doc] = text
    assert texts(left) == expected and len(expected) < given.count()


def test_one_of_each_text_stays(steps):
    given, left = steps["exact_dedup"]
    least = {}
    for doc, text in sorted(texts(given).items()):
        least.setdefault(normal(text), doc)
    assert set(texts(left)) == set(least.values())


def test_one_of_each_component_stays(steps):
    given, left = steps["simhash_near_dedup"]
    rows = list(texts(given).items())
    assert set(texts(left)) == {first(rows[i][0] for i in group) for group in plain_groups([t for _, t in rows])}


def test_repeated_passages_go(steps):
    given, left = steps["substring_dedup"]
    rows = sorted(texts(given).items())
    expected = {}
    for (doc, text), (ws, gone) in zip(rows, without_repeats(rows)):
        if not gone:
            expected[doc] = text
        elif len(gone) < len(ws):
            expected[doc] = " ".join(w for i, w in enumerate(ws) if i not in gone)
    assert texts(left) == expected
    assert any(expected[d] != t for d, t in rows if d in expected)
    for r in left.collect():
        assert r["n_chars"] == len(r["text"])


def test_documents_are_packed_whole(steps):
    given, packed = steps["best_fit_packing"]
    path = public_tokenizers.path("word_bpe_49k.json")
    lengths = {doc: len(ids_of(path, t)) + 1 for doc, t in texts(given).items()}
    rows = packed.collect()
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["length"]
    assert got == lengths
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.01 * -(-sum(lengths.values()) // 4096)


def test_columns_stay(steps):
    for name, (given, left) in steps.items():
        if name != "best_fit_packing":
            assert left.dtypes == given.dtypes


def test_run_applies_all_stages(spark, steps, tmp_path):
    for name in ("documents", "labels"):
        shutil.copyfile(f"{SIZES}/{name}.parquet", tmp_path / f"{name}.parquet")
    got = {(r["doc_id"], r["piece"], r["length"]) for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {(r["doc_id"], r["piece"], r["length"]) for r in steps["best_fit_packing"][1].collect()}


@pytest.mark.parametrize("name", list(STEPS))
def test_odd_rows_and_empty_tables(spark, name):
    docs = table(spark, ODD).repartition(2)
    out = STEPS[name](spark, docs, SIZES)
    empty = STEPS[name](spark, docs.limit(0), SIZES)
    assert empty.count() == 0 and out.count() > 0
    if name == "best_fit_packing":
        assert {r["doc_id"] for r in out.collect()} == {d for d, _ in ODD}
        return
    assert out.columns == docs.columns == empty.columns
    got = Counter((r["doc_id"], normal(r["text"])) for r in out.collect())
    if name == "toxicity":
        assert sum(got.values()) == len(ODD)
    elif name == "exact_dedup":
        assert Counter(t for _, t in got.elements()) == Counter({normal(t): 1 for _, t in ODD})
    elif name == "simhash_near_dedup":
        assert {fingerprint(t) for _, t in got} <= {fingerprint(t) for _, t in ODD}
    else:
        assert all(words(t) or not words(dict(ODD).get(d)) for d, t in got)


def test_stages_hand_few_texts_to_python_at_a_time(spark):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", table(spark, ODD)
    before = spark.conf.get(key)
    try:
        for name in ("toxicity", "simhash_near_dedup", "substring_dedup", "best_fit_packing"):
            spark.conf.set(key, "10000")
            STEPS[name](spark, docs, SIZES)
            given = spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long").collect()
            assert sum(r["n"] for r in given) == 9000 and max(r["n"] for r in given) <= 2000
    finally:
        spark.conf.set(key, before)
