"""Column functions against plain Python."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_lake.functions import dates, privacy, text
from activity_lake.functions.business import (
    bonus_amount, is_eligible, margin_kms, max_distance, with_distance, with_geodesic,
)
from tests.helpers import rows, value, values

KEY = "0123456789abcdef"


def ts(*parts):
    return F.expr(f"timestamp_ntz'{dt.datetime(*parts)}'")


@pytest.mark.parametrize("month, first, expected", [
    (6, 6, "2023-2024"), (7, 6, "2024-2025"), (1, 6, "2023-2024"), (12, 6, "2024-2025"),
    (9, 9, "2023-2024"), (10, 9, "2024-2025"),
])
def test_social_year(spark, month, first, expected):
    # The first month itself still counts to the year before.
    assert value(spark, dates.social_year(ts(2024, month, 15), first)) == expected


def test_epochs_are_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert value(spark, dates.activity_date(F.lit(1704067798778549))) == dt.datetime(2024, 1, 1, 0, 9, 58)
        assert value(spark, dates.epoch_micros(ts(2024, 1, 1, 0, 9, 58, 778549))) == 1704067798778549
        assert value(spark, dates.to_epoch(ts(2024, 1, 1, 0, 9, 58, 778549))) == 1704067798
        assert value(spark, dates.from_epoch(F.lit(1765092782))) == dt.datetime(2025, 12, 7, 7, 33, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ages(spark):
    since = [("2000-01-01",), ("bad",), (None,), ("2027-01-01",), ("2025-01-01",), ("2025-01-02",)]
    got = values(spark, since, "d string", dates.full_years("d", "2026-01-01"))
    days = lambda d: (dt.date(2026, 1, 1) - dt.date.fromisoformat(d)).days // 365
    assert got == [days("2000-01-01"), 0, 0, days("2027-01-01"), 1, 0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n  Éàb-/ç\"x", max_size=12), min_size=1, max_size=60))
def test_text_like_python(spark, texts):
    data = [(t,) for t in texts]
    assert values(spark, data, "t string", text.strip("t")) == [t.strip() for t in texts]
    assert values(spark, data, "t string", text.words("t")) == [len(t.split()) for t in texts]
    assert values(spark, data, "t string", text.answer_tokens("t")) == [int(len(t.split()) * 1.3) for t in texts]
    assert values(spark, data, "t string", text.prompt_tokens("t")) == [int(len(t) * 1.3) for t in texts]
    assert values(spark, data, "t string", text.clean_comment("t")) == [t.replace('"', "'").strip() for t in texts]


def test_normalize_text(spark):
    got = values(spark, [("  Éa-b/ç ",), ("ÀÔ ï",), (None,)], "t string", text.normalize_text("t"))
    assert got == ["ea b ç", "ao i", None]


def test_performance_like_python(spark):
    meters = list(range(0, 30_000, 7)) + list(range(50, 200_000, 100))
    got = values(spark, [(m,) for m in meters], "m int", text.format_performance("m", F.lit(4000)))
    assert got == [f"{round(m / 1000, 1)} km en 1h06" if m else "1h06" for m in meters]
    seconds = [0, 59, 60, 3599, 3600, 3660, 86_399]
    clock = values(spark, [(s,) for s in seconds], "s int", text.format_performance(F.lit(None).cast("int"), "s"))
    assert clock == ["0 min", "0 min", "1 min", "59 min", "1h00", "1h01", "23h59"]


def test_names_and_defaults(spark):
    data = [("Ana", "Blanc"), ("Ana", None), ("Ana", "")]
    assert values(spark, data, "f string, l string", text.display_name("f", "l")) == ["Ana B.", "Ana", "Ana"]
    assert values(spark, [("x",), ("",), (None,)], "s string", text.default_comment("s")) == [
        "Bypass IA : x", "Bypass IA : No comment", "Bypass IA : No comment"]
    assert values(spark, [("", "b"), (None, ""), ("a", "b")], "a string, b string",
                  text.first_filled("a", "b", default="d")) == ["b", "d", "a"]
    assert value(spark, text.activity_key(ts(2026, 2, 13, 12, 21), F.lit("x"))).startswith("ACT-260213-1221-")


def test_answers(spark):
    good = '{"results":[{"id":"1","comment":"a\\nb"}]}'
    data = [(good,), (f"```json\n{good}\n```",), ("sorry",), (None,)]
    parsed = values(spark, data, "t string", text.parse_answer("t")["results"]["comment"])
    assert parsed == [["a\nb"], ["a\nb"], None, None]


def test_bonus(spark):
    data = [("Marche/running", 0.0), ("Marche/running", -0.1), ("Transports en commun", 5.0), (None, 1.0),
            ("Vélo/Trottinette/Autres", None)]
    eligible = is_eligible("mode", "margin")
    assert values(spark, data, "mode string, margin double", eligible) == [True, False, False, False, False]
    amounts = values(spark, data, "mode string, margin double", bonus_amount(eligible, F.lit("30000.50")))
    assert amounts == [1500.025, 0.0, 0.0, 0.0, 0.0]
    assert values(spark, data, "mode string, margin double", max_distance("mode")) == [15, 15, 150, 0, 25]
    assert value(spark, margin_kms(F.lit("?"), F.lit(3.5))) == -3.5


def test_geodesic(spark):
    # One degree along the equator and along a meridian; published lengths in km.
    points = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0), (44.5, 0.0, 45.5, 0.0), (10.0, 10.0, 10.0, 10.0),
         (10.0, 10.0, None, 1.0)], "a double, b double, c double, d double")
    got = [r["km"] for r in with_geodesic(points, ("a", "b"), ("c", "d"), "km").collect()]
    assert got[:4] == pytest.approx([111.319491, 110.574389, 111.131778, 0.0], abs=1e-5) and got[4] is None


def test_distance_policies(spark):
    people = spark.createDataFrame(
        [("1", "Marche/running", "x"), ("2", "Transports en commun", "x"), ("3", "?", "x"),
         ("4", "Marche/running", "nowhere")], "id string, transport_mode string, address string")
    geo = spark.createDataFrame([("x", 1.0, 0.0), ("x", 1.0, 0.0)], "address string, lat double, lon double")

    def measured(policy):
        return [r[0] for r in with_distance(people, geo, (0.0, 0.0), policy).orderBy("id").select("distance_kms").collect()]

    assert measured("All") == [110.57, 110.57, 0.0, None]
    assert measured("Relevants") == [110.57, 0.0, 0.0, None]
    assert measured("None") == [0.0, 0.0, 0.0, 0.0]


def test_privacy(spark):
    df = spark.createDataFrame([("1", "é", None), ("2", "", "x")], "id string, a string, b string")
    sealed = privacy.encrypt(df, ["a", "b"], KEY)
    assert rows(privacy.decrypt(sealed, ["a", "b"], KEY)) == [("1", "é", None), ("2", "", "x")]
    other = privacy.decrypt(sealed, ["a", "b"], "another-16-bytes")
    assert rows(other) == [("1", "Error_Decrypt", None), ("2", "Error_Decrypt", "Error_Decrypt")]
    assert values(spark, [("no cipher",)], "c string", privacy.decrypted("c", KEY)) == ["Error_Decrypt"]


def test_carried_over_comments_are_encrypted_once(spark):
    actions = spark.createDataFrame(
        [("1", "left_only", "new"), ("2", "right_only", "sealed already")], "id string, _merge string, comment string")
    sealed = privacy.encrypt_new(actions, "comment", KEY)
    got = dict(rows(sealed.select("id", "comment")))
    assert got["2"] == "sealed already" and got["1"] != "new"
