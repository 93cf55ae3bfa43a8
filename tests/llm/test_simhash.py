import random

import numpy as np
import pytest

from activity_lake.llm.graph import components
from activity_lake.llm.simhash import (
    chain_masks, finer_masks, fingerprint as fast, near_links, signed, simhash_groups,
)
from tests.llm.helpers import ODD, fingerprint, first, linked, table


def plain(rows):
    values = {i: fingerprint(t) for i, (_, t) in enumerate(rows)}
    out = []
    for group in linked(values.values()):
        ids = [rows[i][0] for i, v in values.items() if v in group]
        out += [(rows[i][0], signed(v), first(ids)) for i, v in values.items() if v in group]
    return sorted(map(str, out))


def test_fingerprints(spark):
    for _, text in ODD:
        assert fast((text or "").encode()) == fingerprint(text)


@pytest.mark.parametrize("bucket_rows", [2000, 2, 1])
def test_groups_equal_plain_ones(spark, bucket_rows):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    rows = [*ODD]
    for k in range(60):
        ws = list(base)
        for _ in range(k % 6):
            ws[rng.randrange(80)] = f"new{k}"
        rows.append((100 + k, " ".join(ws)))
    got = simhash_groups(table(spark, rows), bucket_rows=bucket_rows, bin_rows=50).collect()
    assert sorted(str((r["doc_id"], r["fp"], r["component_id"])) for r in got) == plain(rows)


def test_every_linked_pair_shares_a_part():
    rng = random.Random(5)
    masks = [m for _, m in chain_masks()]
    for _ in range(5000):
        differing = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        shared = [m for m in masks if not differing & m]
        assert shared
        # Splitting a bucket keeps the pair together in one of the finer parts.
        for m in shared[:2]:
            while 64 - m.bit_count() > 14:
                m = next(f for f in finer_masks(m) if not differing & f)


@pytest.mark.parametrize("bucket_rows", [2000, 5])
def test_links_join_a_dense_cloud(spark, bucket_rows):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    cloud = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))}
    far = {int(x) for x in rng.integers(0, 1 << 62, 200)}
    nodes = spark.createDataFrame([(signed(x),) for x in cloud | far], "fp long")
    links = near_links(nodes, bucket_rows, 100)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    for group in linked(cloud | far):
        assert len({roots.get(signed(x), signed(x)) for x in group}) == 1
    assert len({roots.get(signed(x), signed(x)) for x in cloud | far}) == len(linked(cloud | far))


def test_links_seen_from_one_start_only_are_kept_in_full_buckets(spark):
    rng = random.Random(9)
    values, pairs = set(), []
    for start in range(8):
        byte = lambda k, x: x << 8 * ((start + k) % 8)
        shared = sum(byte(k, rng.randrange(256)) for k in range(5))
        one, *others = [shared | sum(byte(k, rng.randrange(256)) for k in (5, 6, 7)) for _ in range(300)]
        two = one ^ sum(byte(k, 1 << rng.randrange(8)) for k in (5, 6, 7))
        values |= {one, two} | {x for x in others if min((x ^ one).bit_count(), (x ^ two).bit_count()) > 6}
        pairs.append((one, two))
    nodes = spark.createDataFrame([(signed(x),) for x in values], "fp long")
    roots = {r["node"]: r["root"] for r in components(near_links(nodes, 50, 500)).collect()}
    root = lambda x: roots.get(signed(x), signed(x))
    assert [s for s, (a, b) in enumerate(pairs) if root(a) != root(b)] == []
    groups = linked(values)
    assert all(len({root(x) for x in group}) == 1 for group in groups)
    assert len({root(x) for x in values}) == len(groups)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (100, 101)]
    rng = random.Random(2)
    rng.shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}


def test_empty_table(spark):
    assert simhash_groups(table(spark, ODD).limit(0)).count() == 0
