import random
from collections import Counter

import numpy as np

import corpus_pipeline as pipeline
from activity_lake.llm.common import documents
from activity_lake.llm import near_copies
from activity_lake.llm.near_copies import most_common, near_copy_groups, parity_map, shared_prefixes
from tests.llm.helpers import ODD, first, table, words

SIZES = "/root/testdata/sf0.01"


def plain_set(text):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])


def plain_groups(texts):
    """Groups of places in ``texts`` that a Jaccard similarity of 0.8 joins, by comparing all pairs."""
    nodes = {}
    for i, t in enumerate(texts):
        nodes.setdefault(plain_set(t), []).append(i)
    left, groups = list(nodes), []
    while left:
        group = [left.pop()]
        for x in group:
            near = [y for y in left if x and y and 5 * len(x & y) >= 4 * len(x | y)]
            group += near
            left = [y for y in left if y not in near]
        groups.append([i for x in group for i in nodes[x]])
    return groups


def test_groups_equal_plain_ones(spark):
    rng = random.Random(4)
    rows, common = [*ODD], " ".join(f"footer{i}" for i in range(30))
    for k in range(60):
        ws = [f"w{k % 12}x{i}" for i in range(80)]
        for _ in range(k % 5):
            ws[rng.randrange(80)] = f"new{k}"
        rows.append((100 + k, " ".join(ws)))
    # A chain: neighbours are alike, others are not; and texts that share only a passage.
    rows += [(200 + k, " ".join(f"c{i}" for i in range(8 * k, 8 * k + 100))) for k in range(12)]
    rows += [(300 + k, common + " " + " ".join(f"own{k}x{i}" for i in range(20))) for k in range(20)]
    expected = Counter()
    for group in plain_groups([t for _, t in rows]):
        ids = [rows[i][0] for i in group]
        expected.update((d, first(ids)) for d in ids)
    assert 1 < max(Counter(c for _, c in expected).values()) and len({c for _, c in expected}) > 20
    got = near_copy_groups(table(spark, rows)).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == expected
    assert near_copy_groups(table(spark, rows).limit(0)).count() == 0


def test_the_stage_keeps_no_near_copy_and_drops_nothing_else(spark):
    docs = documents(spark, SIZES)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = plain_groups([t for _, t in rows])
    kept = {r["doc_id"] for r in pipeline.without_near_copies(spark, docs, SIZES).collect()}
    assert kept == {first(rows[i][0] for i in group) for group in groups}


def test_maps_never_allow_too_little():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 70, 900, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for part in (0.0, 0.5, 0.9, 1.0):
            b = np.unique(np.concatenate([a[:int(len(a) * part)], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            assert most_common(len(a), len(b), parity_map(a), parity_map(b)) >= common
    a, b = (np.unique(rng.integers(0, 1 << 63, 2000).astype(np.uint64)) for _ in "ab")
    assert 180 * most_common(2000, 2000, parity_map(a), parity_map(b)) < 80 * 4000


def test_boilerplate_gives_candidates_in_proportion(spark):
    shared = " ".join(f"footer{i}" for i in range(600))

    def filed(k):
        rows = [(d, " ".join(f"own{d}x{i}" for i in range(190)) + " " + shared) for d in range(k)]
        return shared_prefixes(table(spark, rows).select("doc_id", "text")).count()

    few, many = filed(50), filed(200)
    assert many <= 4 * max(few, 50)


def test_frequent_shingles_are_dealt_without_loss(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "HOT", 0)
    monkeypatch.setattr(near_copies, "SAMPLE", 1)
    rng = random.Random(7)
    rows = []
    for k in range(90):
        ws = [f"w{k % 3}x{i}" for i in range(60)]
        ws[rng.randrange(60)] = f"new{k}"
        rows.append((k, " ".join(ws)))
    groups = plain_groups([t for _, t in rows])
    got = {(r["doc_id"], r["component_id"]) for r in near_copy_groups(table(spark, rows)).collect()}
    assert got == {(rows[i][0], first(rows[j][0] for j in g)) for g in groups for i in g}


def test_runs_are_the_same_over_any_batches():
    rng = np.random.default_rng(5)
    rows = sorted((int(s), int(s % 2) - 1, int(n)) for s, n in zip(rng.integers(0, 40, 300), rng.integers(-9, 9, 300)))
    least, nodes = {}, {}
    for s, salt, n in rows:
        least.setdefault((s, salt), n)
        nodes.setdefault((s, salt), set()).add(n)
    want = {(s, n, least[s, salt]) for (s, salt), ns in nodes.items() if len(ns) > 1 or salt >= 0 for n in ns}
    for size in (1, 2, 7, 300):
        batches = [near_copies.pa.RecordBatch.from_pylist(
            [dict(zip(("shingle", "salt", "node"), r)) for r in rows[i:i + size]]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in near_copies._shared(iter(batches)) for r in b.to_pylist()]
        assert set(got) == want


def test_texts_too_unlike_in_size_are_no_candidates(spark):
    passage = " ".join(f"quoted{i}" for i in range(40))
    # Each shares a passage with all others and is a third longer than the one before.
    rows = [(k, passage + " " + " ".join(f"own{k}x{i}" for i in range(int(100 * 1.34 ** k) - 40))) for k in range(12)]
    assert shared_prefixes(table(spark, rows).select("doc_id", "text")).count() == 0
    rows.append((90, rows[-1][1] + " more"))
    assert {(r["doc_id"], r["component_id"]) for r in near_copy_groups(table(spark, rows)).collect()} == {
        *((k, k) for k in range(12)), (90, 11)}


def test_partners_are_those_of_all_pairs(monkeypatch):
    names = ["shingle", "salt", "node", "n", "left"]
    rng, sizes = random.Random(6), {k: random.Random(k).randrange(20, 60) for k in range(80)}
    rows = sorted({(s, -1, node, sizes[node], sizes[node] - (7 * s + node) % 12)
                   for s in range(30) for node in rng.sample(range(80), rng.choice((1, 2, 5, 40)))})
    rows += [(40, salt, 100 * salt + k, 9 ** k, 9 ** k) for salt in range(2) for k in range(3)]
    rows += [(50, -1, k, 9 ** k, 9 ** k) for k in range(9)]

    def alike(x, y):
        return x[0] == y[0] and x[2] != y[2] and 180 * min(x[4], y[4]) >= 80 * (x[3] + y[3])

    def given(at_a_time):
        batches = [near_copies.pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i:i + at_a_time]])
                   for i in range(0, len(rows), at_a_time)]
        return [tuple(r.values()) for b in near_copies._partners(80)(iter(batches)) for r in b.to_pylist()]

    want = [r[:3] for r in rows if r[1] >= 0 or any(alike(r, x) for x in rows)]
    assert 100 < len(want) < len(rows) - 20
    for at_a_time in (1, 3, 50, len(rows)):
        monkeypatch.undo()
        monkeypatch.setattr(near_copies, "NEIGHBOURS", 100)
        assert given(at_a_time) == want
        # Shorter looks and runs that are not held may give more rows, never fewer, and none twice.
        for name, value in (("NEIGHBOURS", 2), ("RUN_ROWS", 4)):
            monkeypatch.setattr(near_copies, name, value)
            got = given(at_a_time)
            assert set(want) <= set(got) and len(got) == len(set(got))


def test_maps_take_two_bits_a_value_at_most():
    rng = np.random.default_rng(8)
    for n in (64, 100, 1000, 1025):
        values = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        assert 8 * len(parity_map(values)) <= 2 * n


def test_what_simhash_links_is_found_without_prefixes(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for k in range(40):
        ws = [f"w{k // 4}x{i}" for i in range(3000)]
        if k % 4:
            ws[rng.randrange(3000)] = f"new{k}"
        rows.append((k, " ".join(ws)))
    found = near_copies.simhash_pairs
    pairs = []
    monkeypatch.setattr(near_copies, "simhash_pairs", lambda nodes: pairs.append(found(nodes)) or pairs[-1])
    monkeypatch.setattr(near_copies, "shared_prefixes", lambda *_: spark.createDataFrame(
        [], "shingle long, node long, least long"))
    groups = plain_groups([t for _, t in rows])
    got = {(r["doc_id"], r["component_id"]) for r in near_copy_groups(table(spark, rows)).collect()}
    assert got == {(rows[i][0], first(rows[j][0] for j in g)) for g in groups for i in g}
    assert len({c for _, c in got}) == 10


def test_simhash_links_that_are_not_alike_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "set_fingerprint", lambda values: 0)
    rows = [(k, " ".join(f"w{k // 2}x{i}" for i in range(k % 2, 60 + k % 2))) for k in range(12)]
    got = {(r["doc_id"], r["component_id"]) for r in near_copy_groups(table(spark, rows)).collect()}
    assert got == {(k, k - k % 2) for k in range(12)}


def test_set_fingerprints_are_majorities():
    rng = np.random.default_rng(9)
    assert near_copies.set_fingerprint(np.zeros(0, np.uint64)) == 0
    for n in (1, 2, 7, 300):
        values = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        bits = sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in values) > n)
        assert near_copies.set_fingerprint(values) & ((1 << 64) - 1) == bits
