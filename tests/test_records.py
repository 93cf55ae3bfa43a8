"""Sheets with line breaks in cells, cut anywhere."""

import csv
import random

import pytest
from activity_lake import schemas
from activity_lake.sources.records import quoted_records
from activity_lake.sources.tables import typed_scan
from pyspark.sql import functions as F
from tests.helpers import plan, rows


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def sheet(path, data, end="\n"):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "sport\ntype"])
        writer.writerows(data)


def made(n, seed):
    draw = random.Random(seed)
    cells = ["run", "a, b", 'say "hi"', '"', "two\nlines", "\n", '\n\n"\n', 'x\n"y"\nz', "é\n🙂", "long " * 60, "l\n" * 200]
    return [(str(i), draw.choice(cells)) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_cut_where_quotes_are_even(spark, tmp_path, small_blocks, end):
    for k in range(3):
        sheet(tmp_path / f"{k}.csv", made(300, k), end)
    df = typed_scan(spark, str(tmp_path), schemas.SPORT_SHEET, multi_line=True)
    assert rows(df) == sorted((r for k in range(3) for r in made(300, k)), key=repr)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    numbers = quoted_records(spark, str(tmp_path)).groupBy("file").agg(F.max("number"), F.count("*")).collect()
    assert [tuple(r)[1:] for r in numbers] == [(301, 301)] * 3
    assert "multiLine" not in plan(df)


def test_a_missing_quote_does_not_gather_the_rest(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('id,sport\n1,run\n2,"broken\n' + "".join(f"{i},x\n" for i in range(3, 900)))
    found = quoted_records(spark, str(tmp_path), max_lines=100)
    assert found.count() == 900 and found.filter("record = '500,x'").count() == 1


def test_rejects_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,"a\nb"\nx,"c\nd"\n\n')
    schema = schemas.T.StructType.fromDDL("n int, t string")
    df = typed_scan(spark, str(tmp_path), schema, multi_line=True, reject_column="bad")
    assert rows(df) == sorted([(1, "a\nb", None), (None, "c\nd", 'x,"c\nd"')], key=repr)
    (tmp_path / "a.csv").write_text("")
    assert typed_scan(spark, str(tmp_path), schema, multi_line=True).count() == 0
