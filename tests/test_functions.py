"""Hand-computed values of the column functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from courtside.functions import arrays, dates, rates, text
from courtside.functions.similarity import indel_ratio


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_null_rules(spark):
    assert values(spark, text.null_tokens(F.col("x")), ["[]", "", "NaN", None, "1"]) == [None] * 4 + ["1"]
    assert values(spark, text.nan_to_null(F.col("x")), [float("nan"), 1.5, None], "x double") == [None, 1.5, None]


def test_percent_and_digits(spark):
    raw = ["65%", "65.5%", "[]", None, "abc"]
    assert values(spark, text.percent(F.col("x")), raw) == [0.65, 0.655, None, None, None]
    assert values(spark, text.digits(F.col("x")), raw) == [65.0, 655.0, None, None, None]


def test_height_and_age(spark):
    assert values(spark, text.first_number(F.col("x")), ["(190cm)", "cm", None]) == [190, None, None]
    age = dates.age_in(F.lit(2020), F.col("x"))
    assert values(spark, age, [" (1990.05.22) ", "(1990)", "", None]) == [30, None, None, None]


def test_date_range(spark):
    raw = ["2020.01.06 - 2020.01.12", "2020.01.06", "bad"]
    assert values(spark, dates.range_year(F.col("x")), raw) == [2020, 2020, None]
    assert values(spark, dates.range_days(F.col("x")), raw) == [6, None, None]
    assert values(spark, dates.range_start(F.col("x")), raw)[:2] == [datetime.date(2020, 1, 6)] * 2


def test_points(spark):
    assert values(spark, text.thousands(F.col("x")), ["1,234", "950", "[]"]) == [1234.0, 950.0, None]
    assert values(spark, text.thousands(F.col("x"), compat=True), ["1,234", "950"]) == [1.234, 950.0]


def test_url_parts(spark):
    url = "https://example.test/en/players/rafa/player-stats?year=2020&surfaceType=clay"
    assert values(spark, text.url_surface(F.col("x")), [url, "none"]) == ["clay", None]
    assert values(spark, text.url_player(F.col("x")), [url, "none"]) == ["rafa", None]
    assert values(spark, text.badge_points(F.col("x")), ["/a/categorystamps_250.png", "/b/itf_grandslam.png"]) == [
        "250", "grandslam"]


def test_plays(spark):
    raw = [" Left-Handed, Two-Handed Backhand ", "Nelen Brodar", ""]
    assert values(spark, text.hand(text.clean_plays(F.col("x"))), raw) == [
        "Left-Handed", "Right-Handed", "Right-Handed"]


def test_fixture_names(spark):
    title = "Auger-Aliassime, Felix - Nadal, Rafael"
    side = [text.fixture_player(text.fixture_side(F.col("x"), s)) for s in (0, 1)]
    assert values(spark, F.array(*side), [title, "Nadal"]) == [["felix auger-aliassime", "rafael nadal"], [None, None]]
    compat = text.fixture_player(text.fixture_side(F.col("x"), 0, compat=True))
    assert values(spark, compat, [title, "Nadal, Rafael - B, C"]) == [None, "rafael nadal"]


@pytest.mark.parametrize("raw, odds", [("5/4", 2.25), ("2", 3.0), ("x", None), ("1/0", None), ("1/2/3", None), (None, None)])
def test_odds(spark, raw, odds):
    assert values(spark, rates.decimal_odds(F.col("x")), [raw]) == [odds]


def test_rank_gap(spark):
    rows = [(10, 10), (10, 40), (40, 10), (None, 10), (300, 0)]
    df = spark.createDataFrame(rows, "a int, b int").select(rates.rank_gap(F.col("a"), F.col("b")).alias("g"))
    got = [(round(r.g.rate0, 6), round(r.g.rate1, 6)) for r in df.collect()]
    assert got == [(0.5, 0.5), (0.55, 0.45), (0.45, 0.55), (0.016667, 0.983333), (0.0, 1.0)]
    assert all(abs(a + b - 1) < 1e-9 for a, b in got)


def test_rate_pairs(spark):
    rows = [(0.4, 0.6), (40.0, 60.0), (0.4, 0.4), (None, 0.5)]
    df = spark.createDataFrame(rows, "a double, b double").select(
        rates.normalise_pair(F.col("a"), F.col("b")).alias("p")).select("p.*")
    got = [tuple(r) for r in df.collect()]
    assert got == [(0.4, 0.6), (0.4, 0.6), (0.5, 0.5), (0.5, 0.5)]
    again = [tuple(r) for r in df.select(
        rates.normalise_pair(F.col("rate0"), F.col("rate1")).alias("p")).select("p.*").collect()]
    assert again == got


def test_surface_and_phase(spark):
    assert values(spark, rates.stats_surface(F.col("x")), ["Outdoor Hard", "Clay", "Indoor Carpet", "Grass", "Sand"]) == [
        "hard", "clay", "grass", "grass", "Sand"]
    assert values(spark, rates.phase_ordinal(F.col("x")), ["Robin", "Round of 64", "Final", "4", "Lucky"]) == [1, 3, 8, 4, None]
    assert values(spark, rates.tournament_points(F.col("x")), ["finals", "grandslam", "500", None]) == [
        2000.0, 2000.0, 500.0, 250.0]


def test_flags_with_else_branch(spark):
    df = spark.createDataFrame([("Indoor", "CLAY", "Left-Handed"), ("x", "sand", "?")], "i string, s string, p string")
    rows = df.select(*rates.in_out_flags(F.col("i")), *rates.surface_flags(F.col("s")), *rates.hand_flags(F.col("p"))).collect()
    assert tuple(rows[0]) == (1, 0, 0, 1, 0, 0, 1, 0)
    assert tuple(rows[1]) == (0, 1, 0, 0, 0, 1, 0, 1)


POSITIONS = [0, 1, 2, 3, 6, 7, 14, 15, 30, 31]


def rounds_at(spark, rounds, compat):
    df = spark.createDataFrame([(rounds, p) for p in POSITIONS], "r array<string>, p int")
    return [r[0] for r in df.select(arrays.round_of(F.col("r"), F.col("p"), compat)).collect()]


def test_rounds(spark):
    rounds = ["F", "SF", "QF", "R16", "R32", "2nd Qualifying", "1st Qualifying"]
    assert rounds_at(spark, rounds, False) == [
        "F", "SF", "SF", "QF", "QF", "R16", "R16", "R32", "R32", "Qualification"]
    assert rounds_at(spark, rounds, True) == [
        "F", "SF", "SF", "QF", "QF", "R16", "R16", "R16", "R16", "R32"]
    plain = ["F", "SF", "QF"]
    assert rounds_at(spark, plain, False) == ["F", "SF", "SF", "QF", "QF", "Qualification"] + ["Qualification"] * 4
    assert rounds_at(spark, plain, True) == ["Qualification"] * 10
    assert rounds_at(spark, [], False) == ["Qualification"] * 10


def test_lists(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"],)], "l array<string>")
    row = df.select(
        arrays.every_second(F.col("l")), arrays.without_first(F.col("l")), arrays.without_last(F.col("l"), F.lit(2)),
        arrays.without_last(F.col("l"), F.lit(9))).first()
    assert list(row) == [["a", "c", "e"], ["b", "c", "d", "e"], ["a", "b", "c"], []]
    day = dates.first_date_in(dates.parse_dates(F.array(F.lit("2019.12.30"), F.lit("2020.01.06"))), F.lit(2020))
    assert df.select(day).first()[0] == datetime.date(2020, 1, 6)
    assert df.select(dates.nearest_year(F.array(F.lit(2019), F.lit(2021), F.lit(2010)), F.lit(2020))).first()[0] == 2019


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def ratio(a, b):
    return round(100 * 2 * common(a, b) / (len(a) + len(b))) if a or b else 0


def test_indel_ratio(spark):
    pairs = [("rafael nadal", "rafael-nadal"), ("a", "b"), ("", ""), ("", "x"), ("abcde", "badce"), ("same", "same")]
    df = spark.createDataFrame(pairs, "a string, b string").select(indel_ratio(F.col("a"), F.col("b")).alias("r"))
    assert [r.r for r in df.collect()] == [ratio(a, b) for a, b in pairs]
