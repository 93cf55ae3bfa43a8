import random

import numpy as np
import pytest

from activity_lake.llm.substrings import anchors, least_places, substring_dedup
from tests.llm.helpers import ODD, table, without_repeats


def check(spark, rows, **options):
    got = {r["doc_id"]: r for r in substring_dedup(table(spark, rows), **options).collect()}
    assert len(got) == len(rows)
    for (doc, _), (ws, gone) in zip(rows, without_repeats(rows, options.get("window", 20))):
        r = got[doc]
        assert r["n_words"] == len(ws) and r["n_removed"] == len(gone), doc
        assert r["kept_text"] == " ".join(w for i, w in enumerate(ws) if i not in gone)
        assert [i for a, b in r["spans"] for i in range(a, b)] == sorted(gone)


@pytest.mark.parametrize("prefix_rows", [100_000, 3, 0])
def test_equals_plain_removal(spark, prefix_rows):
    rng = random.Random(4)
    passages = [[f"p{k}w{i}" for i in range(rng.randint(18, 90))] for k in range(6)]
    rows = []
    for doc in range(60):
        ws = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            ws += [f"own{doc}x{rng.random()}" for _ in range(rng.randint(0, 6))] + p[a:a + rng.randint(1, 70)]
        rows.append((doc - 5, "  ".join(ws)))
    rows.append((500, "again " * 100))
    rows.append((501, "again " * 45 + "end"))
    check(spark, rows, prefix_rows=prefix_rows, bin_rows=40)


def test_odd_rows(spark):
    rows = [r for r in ODD if r[0] is not None]
    unique = list({r[0]: r for r in rows}.values())
    check(spark, sorted(unique, key=lambda r: r[0]))
    # A null id comes first; rows that repeat an id and text are one document.
    passage = " ".join(f"t{i}" for i in range(25))
    got = substring_dedup(table(spark, [(1, passage), (None, passage), (2, passage + " x"), (2, passage + " x")])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("1", 25), ("2", 25), ("None", 0)]


def test_smaller_windows(spark):
    rows = [(1, "a b c d e f g h"), (2, "x b c d e f y"), (3, "c d e f"), (4, "c d e g")]
    check(spark, rows, window=4, gram=2)


def test_layout_and_carried_columns(spark):
    docs = table(spark, [(1, "a\n  b"), (2, " ".join(f"t{i}" for i in range(21))), (3, " ".join(f"t{i}" for i in range(20)))])
    got = {r["doc_id"]: r for r in substring_dedup(docs, carry=["lang", "kept"], keep_layout=True).collect()}
    assert got[1]["kept_text"] == "a\n  b" and got[3]["kept_text"] == ""
    assert got[2]["carried"].asDict() == {"lang": "en", "kept": "kept"}


def test_empty_table(spark):
    assert substring_dedup(table(spark, ODD).limit(0)).count() == 0


def test_equal_windows_have_their_anchor_at_the_same_place():
    rng = np.random.default_rng(0)
    words = rng.integers(1, 4, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    place, _, lo, hi = anchors(words, 12, 4)
    of = {s: p - s for p, a, b in zip(place, lo, hi) for s in range(a, b + 1)}
    assert sorted(of) == list(range(400 - 11))
    seen = {}
    for s, k in of.items():
        assert seen.setdefault(words[s:s + 12].tobytes(), k) == k
    values = rng.integers(0, 5, 100)
    assert least_places(values, 7).tolist() == [i + int(values[i:i + 7].argmin()) for i in range(94)]
