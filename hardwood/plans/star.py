"""Builders of the star schema: two fact tables and three dimensions from four staging tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from hardwood.functions import season
from hardwood.functions.compat import weekday_name
from hardwood.operators.opponents import with_opponent
from hardwood.operators.packing import pack, unpacked
from hardwood.operators.windows import days_since_previous
from hardwood.sources import schemas
from hardwood.sources.schemas import conform


@dataclass(frozen=True)
class Staging:
    teams: DataFrame
    game_log: DataFrame
    team_stats_base: DataFrame
    team_stats_advanced: DataFrame


@dataclass(frozen=True)
class Star:
    dim_team: DataFrame
    dim_season: DataFrame
    dim_game: DataFrame
    fact_team_game: DataFrame
    fact_team_season: DataFrame


def create_views(tables: Staging | Star) -> None:
    """Make the tables available to ``spark.sql`` under their names, for questions of one's own."""
    for field in fields(tables):
        getattr(tables, field.name).createOrReplaceTempView(field.name)


def dim_team(teams: DataFrame) -> DataFrame:
    return conform(
        teams.withColumnRenamed("id", "team_id").withColumn(
            "conference", season.conference(F.col("abbreviation"))
        ),
        schemas.DIM_TEAM,
    )


def dim_season(game_log: DataFrame) -> DataFrame:
    """One row per season. Ids are made distinct before anything is computed from them."""
    raw = F.col("season_id")
    ids = game_log.select(
        season.season_label(raw).alias("season_id"),
        season.start_year(raw).alias("season_start_year"),
    ).distinct()
    year = F.col("season_start_year")
    return conform(
        ids.withColumns(
            {
                "era": season.era(year),
                "games_in_season": season.games_in_season(year),
                "is_lockout": season.is_lockout(year),
                "is_covid": season.is_covid(year),
            }
        ),
        schemas.DIM_SEASON,
    )


def dim_game(game_log: DataFrame) -> DataFrame:
    """One row per game. The columns that follow from the date are added after the distinct."""
    games = game_log.select(
        "game_id",
        F.to_date("game_date").alias("game_date"),
        season.season_label(F.col("season_id")).alias("season_id"),
    ).distinct()
    date = F.col("game_date")
    return conform(
        games.withColumns(
            {
                "month": F.month(date),
                "day_of_week": weekday_name(date),
                "is_bubble": season.is_bubble(date),
            }
        ),
        schemas.DIM_GAME,
    )


# What a fact has from its own row of the log, and the counts among it.
_ADDED = ("opponent_team_id", "opp_pts", "rest_days", "is_back_to_back")
_OF_LOG = StructType([field for field in schemas.FACT_TEAM_GAME if field.name not in _ADDED])
_COUNTS = [
    field.name for field in _OF_LOG if field.dataType == IntegerType() and field.name != "team_id"
]


def fact_team_game(game_log: DataFrame, **sizing) -> DataFrame:
    """One row per team and game with the opponent and the rest before the game.

    Rest days need a window over teams and seasons, opponents a join over games. The window
    runs on five columns, and its result travels with the opponents, so the wide rows of the
    log are shuffled once: over game ids, which are evenly spread. They have the types of the
    facts by then, and their counts are packed.
    """
    rested = days_since_previous(
        game_log.select(
            "game_id", "team_id", "season_id", "pts", F.to_date("game_date").alias("game_date")
        ),
        keys=["team_id", "season_id"],
        date="game_date",
        name="rest_days",
        tie_break=["game_id"],
        sized_by=game_log,
        **sizing,
    )
    labelled = game_log.withColumns(
        {
            "season_id": season.season_label(F.col("season_id")),
            "is_home": F.coalesce(F.col("matchup").contains("vs."), F.lit(False)),
        }
    )
    paired = with_opponent(
        pack(conform(labelled, _OF_LOG), _COUNTS),
        event="game_id",
        side="team_id",
        opponent="opponent_team_id",
        carry={"pts": "opp_pts"},
        sides=rested,
        own=["rest_days"],
    )
    return conform(
        paired.withColumns(
            {**unpacked(_COUNTS), "is_back_to_back": F.coalesce(F.col("rest_days") == 1, F.lit(False))}
        ),
        schemas.FACT_TEAM_GAME,
    )


def fact_team_season(base: DataFrame, advanced: DataFrame) -> DataFrame:
    joined = base.join(advanced, ["team_id", "location", "season"])
    return conform(joined.withColumnRenamed("season", "season_id"), schemas.FACT_TEAM_SEASON)


def build_star(staging: Staging) -> Star:
    return Star(
        dim_team=dim_team(staging.teams),
        dim_season=dim_season(staging.game_log),
        dim_game=dim_game(staging.game_log),
        fact_team_game=fact_team_game(staging.game_log),
        fact_team_season=fact_team_season(staging.team_stats_base, staging.team_stats_advanced),
    )


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).isNull() for column in columns])


def _shown(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _tally(df: DataFrame, rules: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per rule ``name: (broken, example)`` the rows that break it and one example.

    All rules are counted by one aggregate over ``df``.
    """
    found = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.count_if(broken).alias("violations"),
            F.min(F.when(broken, example)).alias("example"),
        )
        for rule, (broken, example) in rules.items()
    ]
    return df.agg(F.array(*found).alias("found")).select(F.inline("found"))


def _key_rules(table: str, df: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Key values that are NULL or repeated, and those with a NULL in a ``required`` column."""
    rules = {f"{table} key": ((F.col("_rows") > 1) | _any_null(keys), _shown(*keys))}
    counts = [F.count(F.lit(1)).alias("_rows")]
    if required:
        incomplete = F.when(_any_null(required), _shown(*keys, *required))
        counts.append(F.min(incomplete).alias("_incomplete"))
        rules[f"{table} required"] = (F.col("_incomplete").isNotNull(), F.col("_incomplete"))
    return _tally(df.groupBy(*keys).agg(*counts), rules)


def _game_rules(star: Star) -> DataFrame:
    """The rules that are about one game, from one row per game of the facts and of the games.

    Both are reduced on the game before they meet, so the join needs no further shuffle.
    """
    sides = star.fact_team_game.groupBy("game_id", "team_id").agg(F.count(F.lit(1)).alias("copies"))
    facts = sides.groupBy("game_id").agg(
        F.sum("copies").alias("sides"),
        F.count_if((F.col("copies") > 1) | _any_null(["game_id", "team_id"])).alias("repeated"),
    )
    games = star.dim_game.groupBy(F.col("game_id").alias("known_id")).agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(_any_null(["game_date", "season_id"])).alias("incomplete"),
    )
    game, known = F.col("game_id"), F.col("known_id")
    return _tally(
        facts.join(games, game == known, "full"),
        {
            "dim_game key": ((F.col("games") > 1) | (F.col("games").isNotNull() & known.isNull()), _shown("known_id")),
            "dim_game required": (F.col("incomplete") > 0, _shown("known_id")),
            "fact_team_game key": (F.col("repeated") > 0, _shown("game_id")),
            "fact_team_game sides": (F.col("sides") > 2, _shown("game_id", "sides")),
            "fact_team_game game": (game.isNotNull() & known.isNull(), _shown("game_id")),
        },
    )


def _reference_rules(star: Star) -> DataFrame:
    """Teams and seasons that facts name and dimensions lack; NULL is allowed.

    One pass over each fact table. Values are made distinct before they meet the dimensions, so
    a hot team or season is one row by then.
    """

    def named(table: str, df: DataFrame, references: Mapping[str, tuple[str, str]]) -> DataFrame:
        values = [
            F.struct(
                F.lit(f"{table} {name}").alias("rule"),
                F.lit(dimension).alias("dimension"),
                F.col(column).cast("string").alias("value"),
            )
            for name, (column, dimension) in references.items()
        ]
        return df.select(F.inline(F.array(*values)))

    both = {"team": ("team_id", "dim_team"), "season": ("season_id", "dim_season")}
    opponent = {"opponent": ("opponent_team_id", "dim_team")}
    uses = named("fact_team_game", star.fact_team_game, {**both, **opponent}).union(
        named("fact_team_season", star.fact_team_season, both)
    )
    known = star.dim_team.select(
        F.lit("dim_team").alias("dimension"), F.col("team_id").cast("string").alias("value")
    ).union(star.dim_season.select(F.lit("dim_season"), "season_id"))
    unknown = uses.filter(F.col("value").isNotNull()).distinct().join(known, ["dimension", "value"], "left_anti")
    rules = [*(f"fact_team_game {name}" for name in (*both, *opponent)), *(f"fact_team_season {name}" for name in both)]
    return _tally(unknown, {rule: (F.col("rule") == rule, F.col("value")) for rule in rules})


def star_violations(star: Star) -> list[DataFrame]:
    """Every declared key, reference and required value of the star schema, as (rule, violations, example).

    The unit of a violation is the key value, game, team or season concerned. Each table is read
    once or twice, in few columns.
    """
    required = ["season_start_year", "era", "games_in_season", "is_lockout", "is_covid"]
    return [
        _key_rules("dim_team", star.dim_team, ["team_id"]),
        _key_rules("dim_season", star.dim_season, ["season_id"], required),
        _game_rules(star),
        _key_rules("fact_team_season", star.fact_team_season, ["team_id", "season_id", "location"]),
        _reference_rules(star),
    ]


class ConstraintViolation(ValueError):
    """A star table breaks a declared key or holds NULL in a required column."""


def require_valid(star: Star) -> None:
    """Raise on broken rules, naming each with its number of violations and an example."""
    for found in star_violations(star):
        broken = found.filter(F.col("violations") > 0).collect()  # a row per rule at most
        if broken:
            raise ConstraintViolation(
                "; ".join(f"{row.rule}: {row.violations}, such as {row.example}" for row in broken)
            )
