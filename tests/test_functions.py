"""Rounding, casting and season rules, with hand-written cases."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hardwood.functions import compat, season
from hardwood.sources.schemas import conform, table_schema


def values(spark, rows, column="x", kind="double"):
    return spark.createDataFrame([(row,) for row in rows], f"{column} {kind}")


def apply(spark, rows, function, kind="double"):
    df = values(spark, rows, kind=kind)
    return [row[0] for row in df.select(function(F.col("x"))).collect()]


def test_round_half_away(spark):
    assert apply(spark, [0.285, 1.005], lambda x: compat.round_half_away(x, 2)) == [0.28, 1.0]
    assert apply(spark, [0.00015], lambda x: compat.round_half_away(x, 4)) == [0.0001]
    assert apply(spark, [-0.125, 0.125, None], lambda x: compat.round_half_away(x, 2)) == [
        -0.13,
        0.13,
        None,
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=200, max_size=400), st.sampled_from([2, 4]))
def test_round_matches_checking_engine(spark, numbers, digits):
    exact = [n / 1000 for n in range(-50, 50)] + [-0.00001, 0.0, -0.0]
    numbers = numbers + exact
    found = apply(spark, numbers, lambda x: compat.round_half_away(x, digits))
    listed = ", ".join(f"'{n!r}'" for n in numbers)
    sql = f"SELECT round(x::DOUBLE, {digits}) FROM unnest([{listed}]) AS t(x)"
    wanted = [row[0] for row in duckdb.sql(sql).fetchall()]
    assert [repr(x) for x in found] == [repr(x) for x in wanted]


def test_half_even_narrowing(spark):
    numbers = [1.5, 2.5, -12.6, -0.5, 3.0, None]
    assert apply(spark, numbers, compat.to_int_half_even) == [2, 2, -13, 0, 3, None]


def test_weekday_name(spark):
    assert apply(spark, [datetime.date(1999, 11, 4)], compat.weekday_name, "date") == ["Thursday"]


def test_conform_orders_names_and_types(spark):
    df = spark.createDataFrame([(2.5, 7, 0.1)], "PLUS double, ID bigint, pct double")
    out = conform(df, table_schema("id int, plus int, pct float"))
    assert out.dtypes == [("id", "int"), ("plus", "int"), ("pct", "float")]
    assert out.first()[:2] == (7, 2)


def test_conform_rejects_overflow(spark):
    df = spark.createDataFrame([(2**40,)], "id bigint")
    with pytest.raises(Exception, match="OVERFLOW"):
        conform(df, table_schema("id int")).collect()


def test_season_label(spark):
    ids = ["21999", "22000", "22008", "22024", "21996", None]
    assert apply(spark, ids, season.season_label, "string") == [
        "1999-00",
        "2000-01",
        "2008-09",
        "2024-25",
        "1996-97",
        "-",
    ]


@pytest.mark.parametrize(
    "year, era, games, lockout, covid",
    [
        (1995, None, 82, False, False),
        (1996, "Pre-Back-to-Back Reform", 82, False, False),
        (1998, "Pre-Back-to-Back Reform", 50, True, False),
        (2011, "Pre-Back-to-Back Reform", 66, True, False),
        (2016, "Pre-Back-to-Back Reform", 82, False, False),
        (2017, "Schedule Reform", 82, False, False),
        (2018, "Schedule Reform", 82, False, False),
        (2019, "COVID Bubble", 75, False, True),
        (2020, "COVID Compressed", 72, False, True),
        (2021, "Post-COVID", 82, False, False),
        (2024, "Post-COVID", 82, False, False),
        (2025, None, 82, False, False),
    ],
)
def test_season_rules(spark, year, era, games, lockout, covid):
    x = F.col("x")
    row = values(spark, [year], kind="int").select(
        season.era(x), season.games_in_season(x), season.is_lockout(x), season.is_covid(x)
    ).first()
    assert tuple(row) == (era, games, lockout, covid)


def test_bubble_bounds_are_included(spark):
    days = [
        datetime.date(2020, 7, 29),
        datetime.date(2020, 7, 30),
        datetime.date(2020, 10, 11),
        datetime.date(2020, 10, 12),
        None,
    ]
    assert apply(spark, days, season.is_bubble, "date") == [False, True, True, False, False]


def test_conference(spark):
    teams = ["BOS", "WAS", "LAL", "", None]
    assert apply(spark, teams, season.conference, "string") == [
        "East",
        "East",
        "West",
        "West",
        "West",
    ]


# Written by hand, not taken from the rules: each season's label, era, games and flags.
SEASONS = """
1996 1996-97 Pre-Back-to-Back_Reform 82 - -
1997 1997-98 Pre-Back-to-Back_Reform 82 - -
1998 1998-99 Pre-Back-to-Back_Reform 50 lockout -
1999 1999-00 Pre-Back-to-Back_Reform 82 - -
2000 2000-01 Pre-Back-to-Back_Reform 82 - -
2001 2001-02 Pre-Back-to-Back_Reform 82 - -
2002 2002-03 Pre-Back-to-Back_Reform 82 - -
2003 2003-04 Pre-Back-to-Back_Reform 82 - -
2004 2004-05 Pre-Back-to-Back_Reform 82 - -
2005 2005-06 Pre-Back-to-Back_Reform 82 - -
2006 2006-07 Pre-Back-to-Back_Reform 82 - -
2007 2007-08 Pre-Back-to-Back_Reform 82 - -
2008 2008-09 Pre-Back-to-Back_Reform 82 - -
2009 2009-10 Pre-Back-to-Back_Reform 82 - -
2010 2010-11 Pre-Back-to-Back_Reform 82 - -
2011 2011-12 Pre-Back-to-Back_Reform 66 lockout -
2012 2012-13 Pre-Back-to-Back_Reform 82 - -
2013 2013-14 Pre-Back-to-Back_Reform 82 - -
2014 2014-15 Pre-Back-to-Back_Reform 82 - -
2015 2015-16 Pre-Back-to-Back_Reform 82 - -
2016 2016-17 Pre-Back-to-Back_Reform 82 - -
2017 2017-18 Schedule_Reform 82 - -
2018 2018-19 Schedule_Reform 82 - -
2019 2019-20 COVID_Bubble 75 - covid
2020 2020-21 COVID_Compressed 72 - covid
2021 2021-22 Post-COVID 82 - -
2022 2022-23 Post-COVID 82 - -
2023 2023-24 Post-COVID 82 - -
2024 2024-25 Post-COVID 82 - -
"""


def test_every_season(spark):
    wanted = [line.split() for line in SEASONS.strip().splitlines()]
    raw = spark.createDataFrame([(int(w[0]), f"2{w[0]}") for w in wanted], "year int, raw string")
    year = F.col("year")
    found = raw.orderBy("year").select(
        year.cast("string"), season.season_label(F.col("raw")), F.translate(season.era(year), " ", "_"),
        season.games_in_season(year).cast("string"), F.when(season.is_lockout(year), "lockout").otherwise("-"),
        F.when(season.is_covid(year), "covid").otherwise("-"),
    )
    assert [list(row) for row in found.collect()] == wanted


def test_every_team(spark):
    east = "ATL BKN BOS CHA CHI CLE DET IND MIA MIL NYK ORL PHI TOR WAS".split()
    west = "DAL DEN GSW HOU LAC LAL MEM MIN NOP OKC PHX POR SAC SAS UTA".split()
    assert apply(spark, east, season.conference, "string") == ["East"] * 15
    assert apply(spark, west, season.conference, "string") == ["West"] * 15
