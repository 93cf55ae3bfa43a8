from activity_lake.llm.line_rules import line_rules
from tests.llm.helpers import ODD, repeat_words, table, words


def test_figures_equal_plain_ones(spark):
    texts = [t for _, t in ODD] + ["a b c a b c a b", "x\nx\n \nx y\nx", "# $1 *a* <b> 100% | & é€", "a a a a a"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in line_rules(table(spark, rows)).collect()}
    for doc, text in rows:
        ws, r = words(text), got[doc]
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert r["n_words"] == len(ws) and r["word_chars"] == sum(map(len, ws))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text or "")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeat_words(ws)
        assert r["base_failed"] == (len(ws) < 50 or 100 * repeat_words(ws) > 50 * len(ws))


def filler(k, n=60):
    return " ".join(f"w{chr(97 + k % 26)}{chr(97 + i % 26)}{'x' * (i // 26)}{'y' * (k // 26)}" for i in range(n))


def test_common_lines_by_host(spark):
    common = " ".join(f"menu{i}" for i in range(80))
    rows = [(k, f"{filler(k)}\n  {common.upper() if k % 2 else common} ") for k in range(12)]
    docs = table(spark, rows, source="case when doc_id < 11 then 'a' else null end")
    got = {r["doc_id"]: r for r in line_rules(docs, max_docs=10).collect()}
    assert all(got[k]["n_common_lines"] == 1 and got[k]["n_words_left"] == 60 and not got[k]["kept"] for k in range(11))
    assert got[11]["n_common_lines"] == 0 and got[11]["kept"]
    got = line_rules(docs, max_docs=10, min_left_percent=40).collect()
    assert all(r["kept"] for r in got)
    got = line_rules(docs, max_docs=11).collect()
    assert all(r["kept"] and r["n_common_lines"] == 0 for r in got)


def test_common_lines_are_removed(spark):
    rows = [(k, f"Menu {k}\n\n{filler(k)}\n menu  7 \nown {filler(k, 3)}\n") for k in range(12)] + [(12, "alone\n\n"), (13, None)]
    got = {r["doc_id"]: r["text_left"] for r in line_rules(table(spark, rows), with_text=True).collect()}
    assert got == {k: f"\n{filler(k)}\nown {filler(k, 3)}\n" for k in range(12)} | {12: "alone\n\n", 13: ""}
    got = line_rules(table(spark, [(k, "menu 1\nmenu 2" + " " * k) for k in range(12)]), with_text=True).collect()
    assert {r["text_left"] for r in got} == {""}


def test_copies_are_documents_and_repeated_rows_are_one(spark):
    rows = [(k, filler(1)) for k in range(11)] + [(20 + k, f"{filler(2)}\n{filler(2)}") for k in range(10)]
    rows += [(20, f"{filler(2)}\n{filler(2)}")] * 5
    got = line_rules(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all((r["n_common_lines"] == 1 and not r["kept"]) == (r["doc_id"] < 11) for r in got)


def test_rows_without_an_id_are_documents(spark):
    got = line_rules(table(spark, [(None, filler(1))] * 11)).collect()
    assert all(r["n_common_lines"] == 1 for r in got)


def test_empty_table(spark):
    assert line_rules(table(spark, ODD).limit(0)).count() == 0
