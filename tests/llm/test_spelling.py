import random
import re
import zlib
from collections import Counter

from activity_lake.llm.queries import QUERIES
from activity_lake.llm.spelling import DAMAGE, group_variants, rotations, word_counts
from tests.llm.helpers import LONG, ODD, table


def near(a, b):
    """One code point inserted, deleted or replaced, by comparing from both ends."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)):] == b[same + 1:]


def plain(counts):
    rows = {}
    for word, n in counts.items():
        close = sorted((-counts[o], o) for o in counts if near(word, o))
        form = close[0] if close and -close[0][0] >= 5 * n else None
        rows[word] = (form[1] if form else None, n, len(close), -form[0] if form else None)
    out = set()
    for word, (form, n, n_near, form_n) in rows.items():
        root = word
        while rows[root][0]:
            root = rows[root][0]
        out.add((word, form, root, n, n_near, form_n))
    return out


def plain_counts(rows, least=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % DAMAGE == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_groups_equal_all_pairs(spark):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé") for _ in range(draw.randrange(6, 10))): draw.choice([5, 6, 30, 31, 160, 900])
             for _ in range(400)}
    words |= {"aaaaaa": 10, "aaaaaaa": 50, "aaaaaaaa": 250, "aabbaa": 5, "aabbbaa": 25, "abbaaa": 25}
    assert grouped(spark, words) == plain(words)


def test_one_range_holds_a_word_per_character(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = {f"prefix{c}": 5 + i for i, c in enumerate(letters)} | {"prefix": 5000}
    assert grouped(spark, words) == plain(words)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rotations(df).groupBy("prefix").count().agg({"count": "max"}).first()[0] == len(letters) + 1


def test_chains_of_forms(spark):
    words = {"abcdef" + "x" * k: 5 ** (k + 1) for k in range(7)}
    assert grouped(spark, words) == plain(words)
    assert {r[2] for r in grouped(spark, words)} == {"abcdefxxxxxx"}


def test_counts_of_whole_texts(spark):
    rows = ODD + [(i, "Wörter ÄNDERN sich×mit÷ABCDEFg abcdefG " * 3 + LONG[:5000]) for i in range(100, 180)]
    got = {r["word"]: r["n"] for r in word_counts(table(spark, rows, word="'w'", n="1", at="2"), damage=DAMAGE).collect()}
    assert got == plain_counts(rows)


def test_damage_is_optional(spark):
    df = word_counts(table(spark, [(1, "Letters letters short"), (2, None)]), min_count=1)
    assert {tuple(r) for r in df.collect()} == {("letters", 2)}


def test_empty_and_repeated(spark):
    assert grouped(spark, {}) == set()
    assert word_counts(table(spark, []), damage=DAMAGE).collect() == []
    rows = [(3, "repeated")] * 5
    assert {tuple(r) for r in word_counts(table(spark, rows), damage=DAMAGE).collect()} == set(plain_counts(rows).items())


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_counts(rows)
    df = QUERIES["op12_spelling"](spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n").cache()
    assert {r["word"]: r["n"] for r in df.collect()} == counts
    assert {tuple(r) for r in df.collect()} == plain(counts)
