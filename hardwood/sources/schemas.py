"""Explicit schemas of the staging and star tables, and the step that makes a frame conform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from hardwood.functions.compat import to_int_half_even

_TYPES = {
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
}


def table_schema(columns: str) -> StructType:
    """A schema from ``name type`` pairs, usable before a session exists."""
    schema = StructType()
    for column in columns.split(", "):
        name, type_name = column.split()
        schema.add(name, _TYPES[type_name])
    return schema


STAGING_TEAMS = table_schema(
    "id int, full_name string, abbreviation string, nickname string, city string, "
    "state string, year_founded int"
)

STAGING_GAME_LOG = table_schema(
    "season_id string, team_id int, game_id string, game_date string, matchup string, "
    "wl string, pts int, fgm int, fga int, fg_pct double, fg3m int, fg3a int, fg3_pct double, "
    "ftm int, fta int, ft_pct double, oreb int, dreb int, reb int, ast int, stl int, blk int, "
    "tov int, pf int, plus_minus double"
)

# What the season-stats files hold; season and location come from the file name.
STATS_BASE_FILE = table_schema("team_id int, gp int, w int, l int, w_pct double")
STATS_ADVANCED_FILE = table_schema(
    "team_id int, off_rating double, def_rating double, net_rating double, pace double, pie double"
)

STAGING_STATS_BASE = table_schema(
    "team_id int, season string, location string, gp int, w int, l int, w_pct double"
)
STAGING_STATS_ADVANCED = table_schema(
    "team_id int, season string, location string, off_rating double, def_rating double, "
    "net_rating double, pace double, pie double"
)

DIM_TEAM = table_schema(
    "team_id int, full_name string, abbreviation string, nickname string, city string, "
    "state string, year_founded int, conference string"
)

DIM_SEASON = table_schema(
    "season_id string, season_start_year int, era string, games_in_season int, "
    "is_lockout boolean, is_covid boolean"
)

DIM_GAME = table_schema(
    "game_id string, game_date date, month int, day_of_week string, season_id string, "
    "is_bubble boolean"
)

FACT_TEAM_GAME = table_schema(
    "game_id string, team_id int, opponent_team_id int, season_id string, is_home boolean, "
    "wl string, pts int, opp_pts int, fgm int, fga int, fg_pct float, fg3m int, fg3a int, "
    "fg3_pct float, ftm int, fta int, ft_pct float, oreb int, dreb int, reb int, ast int, "
    "stl int, blk int, tov int, pf int, plus_minus int, rest_days int, is_back_to_back boolean"
)

FACT_TEAM_SEASON = table_schema(
    "team_id int, location string, season_id string, gp int, w int, l int, w_pct float, "
    "off_rating float, def_rating float, net_rating float, pace float, pie float"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns by name, in its order, with its types.

    Names are matched without regard to case. Floating-point columns that become integers are
    rounded half to even; every other change of type is a plain cast, which raises on overflow.
    """
    found = {field.name.lower(): field for field in df.schema.fields}

    def column(wanted: StructField) -> Column | str:
        given = found[wanted.name.lower()]
        if (given.name, given.dataType) == (wanted.name, wanted.dataType):
            return wanted.name
        source = F.col(given.name)
        if isinstance(wanted.dataType, IntegerType) and isinstance(given.dataType, FractionalType):
            source = to_int_half_even(source)
        return source.cast(wanted.dataType).alias(wanted.name)

    return df.select(*[column(field) for field in schema.fields])
