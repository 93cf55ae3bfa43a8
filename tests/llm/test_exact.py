from collections import Counter

from activity_lake.llm.exact import drop_copies, exact_dedup
from tests.llm.helpers import LONG, ODD, exact_groups, first, normal, sha, table


def expected(rows):
    out = []
    for text, ids in exact_groups(rows).items():
        keep = first(ids)
        stays = Counter()
        for doc in sorted(ids, key=lambda i: (i is None, i or 0)):
            kept = doc == keep and not stays[doc]
            stays[doc] += 1
            out.append((doc, keep, len(ids), kept, sha(text)))
    return Counter(out)


def test_equals_plain_grouping(spark):
    got = exact_dedup(table(spark, ODD), digest_all=True)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == expected(ODD)


def test_only_open_groups_are_read_whole(spark):
    rows = [(1, "alone in length"), (2, "same size a"), (3, "same size b"), (4, "x" * 70 + "a"), (5, "x" * 70 + "b")]
    got = {r["doc_id"]: r["text_sha256"] for r in exact_dedup(table(spark, rows)).collect()}
    assert got[1] is None and got[2] is None and got[3] is None
    assert got[4] == sha(rows[3][1]) and got[5] == sha(rows[4][1])


def test_long_texts_that_differ_at_the_end(spark):
    rows = [(1, LONG + "a"), (2, LONG + "b"), (3, LONG + "a")]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_empty_table(spark):
    empty = table(spark, ODD).limit(0)
    assert exact_dedup(empty).count() == 0 and drop_copies(empty).columns == empty.columns


def test_drop_copies_keeps_columns_and_one_of_each(spark):
    docs = table(spark, ODD)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    left = Counter(normal(r["text"]) for r in got.collect())
    assert left == Counter({t: 1 for t in exact_groups(ODD)})
    unique = [(1, "a b"), (2, "a  b"), (3, "c")]
    assert sorted(r["doc_id"] for r in drop_copies(table(spark, unique)).collect()) == [1, 3]


def test_other_names(spark):
    docs = spark.createDataFrame([(7, "a", "x"), (8, "a", "y")], "`my.id` long, `body text` string, doc_id string")
    got = {r["doc_id"]: r["kept"] for r in exact_dedup(docs, "my.id", "body text").collect()}
    assert got == {7: True, 8: False}
