"""Season rules: label, era, schedule length and flags from a raw season id such as ``21999``.

The first character of a raw id is the season type; the rest is the year the season starts in.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from hardwood.functions.compat import concat_skip_nulls

# Era name by inclusive range of start years; any other year has no era.
ERAS = (
    (1996, 2016, "Pre-Back-to-Back Reform"),
    (2017, 2018, "Schedule Reform"),
    (2019, 2019, "COVID Bubble"),
    (2020, 2020, "COVID Compressed"),
    (2021, 2024, "Post-COVID"),
)

# Games per team in seasons that were not of the usual length.
USUAL_GAMES = 82
SHORT_SEASONS = {1998: 50, 2011: 66, 2019: 75, 2020: 72}

# Start years of lockout seasons and of COVID seasons.
LOCKOUT_YEARS = (1998, 2011)
COVID_YEARS = (2019, 2020)

# First and last day of bubble play, both included.
BUBBLE_FIRST_DAY = datetime.date(2020, 7, 30)
BUBBLE_LAST_DAY = datetime.date(2020, 10, 11)

# Abbreviations of the teams in the East; every other team is in the West.
EAST_TEAMS = (
    "BOS", "BKN", "NYK", "PHI", "TOR", "CHI", "CLE", "DET", "IND",
    "MIL", "ATL", "CHA", "MIA", "ORL", "WAS",
)


def year_text(raw_season_id: Column) -> Column:
    """The raw season id without its season-type character."""
    return F.substr(raw_season_id, F.lit(2))


def start_year(raw_season_id: Column) -> Column:
    return year_text(raw_season_id).cast("int")


def season_label(raw_season_id: Column) -> Column:
    """``21999`` becomes ``1999-00``."""
    next_year = (start_year(raw_season_id) + F.lit(1)) % F.lit(100)
    return concat_skip_nulls(
        year_text(raw_season_id), F.lit("-"), F.lpad(next_year.cast("string"), 2, "0")
    )


def era(year: Column) -> Column:
    named = F.lit(None).cast("string")
    for first, last, name in reversed(ERAS):
        named = F.when(year.between(first, last), name).otherwise(named)
    return named


def games_in_season(year: Column) -> Column:
    games = F.lit(USUAL_GAMES)
    for short_year, short_games in SHORT_SEASONS.items():
        games = F.when(year == short_year, short_games).otherwise(games)
    return games


def is_lockout(year: Column) -> Column:
    return F.coalesce(year.isin(*LOCKOUT_YEARS), F.lit(False))


def is_covid(year: Column) -> Column:
    return F.coalesce(year.isin(*COVID_YEARS), F.lit(False))


def is_bubble(game_date: Column) -> Column:
    inside = game_date.between(F.lit(BUBBLE_FIRST_DAY), F.lit(BUBBLE_LAST_DAY))
    return F.coalesce(inside, F.lit(False))


def conference(abbreviation: Column) -> Column:
    return F.when(abbreviation.isin(*EAST_TEAMS), "East").otherwise("West")
