"""Ten analyses of home advantage, as functions from the star schema to a result.

They share one shape: reduce the fact table on its own keys first, and join dimensions to the
small result. Facts are therefore never shuffled on a season or a team, whose rows may be very
unevenly spread, and no dimension has to be broadcast to the fact scan. Most start from the
:func:`side_totals`, which a run of all analyses computes once; a single analysis reads only the
columns it needs of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hardwood.functions.compat import round_half_away
from hardwood.operators.metrics import (
    change_from_previous,
    gap,
    mean_of_parts,
    parts,
    win_rate,
    with_ranks,
    with_tier,
    won,
)
from hardwood.operators.sizes import BROADCAST_ROWS, broadcast_if_small
from hardwood.operators.windows import PART, ascending, lay_out, rolling_mean
from hardwood.plans.star import Star
from hardwood.sinks.scratch import keep

# Label by strength tier.
TIER_LABELS = {1: "Top Third", 2: "Middle Third", 3: "Bottom Third"}

# Labels by rest before a game, from the least to the most, and when the last one holds.
REST_LABELS = ("Back-to-Back", "Normal Rest", "Well Rested")
WELL_RESTED_DAYS = 3


def _at_home() -> Column:
    return F.col("is_home")


def _on_road() -> Column:
    return ~F.col("is_home")


def _win() -> Column:
    return won(F.col("wl"))


#: What totals may hold, by name: the column of the facts that is summed and counted.
_MEASURES = {
    "win": _win,
    "margin": lambda: F.col("plus_minus"),
    **{name: lambda name=name: F.col(name) for name in ("fg_pct", "fg3_pct", "fta", "tov")},
}


def side_totals(
    star: Star, by: Sequence[str] = ("team_id", "season_id"), measures: Sequence[str] = tuple(_MEASURES)
) -> DataFrame:
    """Sums and counts of the facts by the columns ``by`` and location; only ``measures`` are read."""
    return star.fact_team_game.groupBy(*by, "is_home").agg(
        F.count(F.lit(1)).alias("games"),
        *[part for name in measures for part in parts(name, _MEASURES[name]())],
    )


def _home_gap(name: str) -> Column:
    """The average at home minus that on the road, over :func:`side_totals` being aggregated."""
    return mean_of_parts(name, _at_home()) - mean_of_parts(name, _on_road())


def _report(df: DataFrame, *order: str) -> DataFrame:
    """A sorted result of one file. For results with a fixed bound, such as a row per season."""
    return df.repartition(1).orderBy(*ascending(order))


def baseline_win_pct(star: Star) -> DataFrame:
    """League-wide win percentage at home and on the road by season."""
    averages = star.fact_team_season.groupBy("season_id", "location").agg(
        F.avg("w_pct").alias("w_pct")
    )
    result = averages.join(star.dim_season, "season_id").select(
        "season_start_year",
        "season_id",
        "era",
        "location",
        round_half_away(F.col("w_pct"), 4).alias("avg_w_pct"),
    )
    return _report(result, "season_start_year", "location")


def hca_trend(star: Star) -> DataFrame:
    """The home-road gap in win percentage by season and its change over the year."""
    location = F.col("location")
    gaps = star.fact_team_season.groupBy("season_id").agg(
        gap(F.col("w_pct"), location == "Home", location == "Road").alias("gap")
    )
    change = change_from_previous(F.col("gap"), "season_start_year")
    return (
        gaps.join(star.dim_season, "season_id")
        .select(
            "season_start_year",
            "season_id",
            "era",
            round_half_away(F.col("gap"), 4).alias("hca_gap"),
            round_half_away(change, 4).alias("yoy_change"),
        )
        .orderBy(*ascending(["season_start_year"]))
    )


def covid_bubble(star: Star, totals: DataFrame) -> DataFrame:
    """Results by era, bubble play and location.

    Bubble games lie in few seasons, and only facts of these seasons have to meet them (every
    fact has its game and that game's season, both checked). The rest comes from the totals.
    """
    bubble = star.dim_game.filter("is_bubble").select("game_id", "season_id")
    seasons = [row.season_id for row in bubble.select("season_id").distinct().collect()]
    in_seasons = F.col("season_id").isin(seasons)
    bubble_games = broadcast_if_small(bubble.select("game_id", F.lit(True).alias("in_bubble")))
    met = (
        star.fact_team_game.filter(in_seasons)
        .join(bubble_games, "game_id", "left")
        .withColumn("is_bubble", F.coalesce("in_bubble", F.lit(False)))
        .groupBy("season_id", "is_bubble", "is_home")
        .agg(
            *parts("win", _win()),
            *parts("margin", F.col("plus_minus")),
            F.count(F.lit(1)).alias("games"),
        )
    )
    rest = totals.filter(~F.coalesce(in_seasons, F.lit(False))).withColumn("is_bubble", F.lit(False))
    measures = ("win_sum", "win_n", "margin_sum", "margin_n", "games")
    by_season = (
        met.unionByName(rest.select(met.columns))
        .groupBy("season_id", "is_bubble", "is_home")
        .agg(*[F.sum(measure).alias(measure) for measure in measures])
    )
    keys = ["era", "is_bubble", "is_home"]
    result = (
        by_season.join(star.dim_season, "season_id")
        .groupBy(*keys)
        .agg(
            round_half_away(mean_of_parts("win"), 4).alias("w_pct"),
            round_half_away(mean_of_parts("margin"), 2).alias("avg_plus_minus"),
            F.sum("games").alias("games"),
        )
    )
    return _report(result, *keys)


def back_to_back(star: Star) -> DataFrame:
    """Results by rest before the game and location."""
    tired, usual, rested = REST_LABELS
    bucket = (
        F.when(F.col("is_back_to_back"), tired)
        .when(F.col("rest_days") >= WELL_RESTED_DAYS, rested)
        .otherwise(usual)
    )
    result = (
        star.fact_team_game.filter(F.col("rest_days").isNotNull())
        .groupBy(bucket.alias("rest_bucket"), "is_home")
        .agg(
            round_half_away(win_rate(F.col("wl")), 4).alias("w_pct"),
            F.count(F.lit(1)).alias("games"),
        )
    )
    return _report(result, "rest_bucket", "is_home")


def shooting_boost(star: Star, totals: DataFrame) -> DataFrame:
    """How much better each team shoots at home, ranked by three-point shooting."""
    boosts = totals.groupBy("team_id").agg(
        _home_gap("fg_pct").alias("fg_boost"), _home_gap("fg3_pct").alias("fg3_boost")
    )
    teams = star.dim_team.select("team_id", "full_name", "conference")
    ranked = with_ranks(boosts.join(teams, "team_id"), {"fg3_boost_rank": "fg3_boost"})
    return ranked.select(
        "full_name",
        "conference",
        round_half_away(F.col("fg_boost"), 4).alias("fg_pct_boost"),
        round_half_away(F.col("fg3_boost"), 4).alias("fg3_pct_boost"),
        "fg3_boost_rank",
    ).orderBy(*ascending(["fg3_boost_rank"]))


def rolling_home_win_pct(star: Star) -> DataFrame:
    """Each team's win percentage over its last ten home games of the season.

    Ordinary groups are laid out in ranges of team and season before the window, which serves
    the window and the final sort with one shuffle.
    """
    keys, order = ["team_id", "season_id"], ["game_date", "game_id"]
    at_home = star.fact_team_game.filter(_at_home())
    home = at_home.select("game_id", *keys, _win().alias("win"))
    games = home.join(star.dim_game.select("game_id", "game_date", "month"), "game_id")
    teams = star.dim_team.select("team_id", "full_name")
    sizes = keep(at_home.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "home_games")
    laid = lay_out(games, keys, sizes) if teams.count() <= BROADCAST_ROWS else None
    if laid is None:
        rolled = rolling_mean(games, keys, order, "win", 10, "rolling", sized_by=star.fact_team_game)
    else:
        frame = Window.partitionBy(PART, *keys).orderBy(*ascending(order)).rowsBetween(-9, 0)
        rolled = laid.withColumn("rolling", F.avg("win").over(frame))
    result = rolled.join(broadcast_if_small(teams), "team_id").select(
        "team_id",
        "full_name",
        "season_id",
        "game_date",
        "month",
        round_half_away(F.col("rolling"), 4).alias("rolling_10_home_w_pct"),
    )
    sort = result.orderBy if laid is None else result.sortWithinPartitions
    return sort(*ascending([*keys, "game_date"]))


def referee_bias(star: Star, totals: DataFrame) -> DataFrame:
    """Free-throw attempts at home and on the road by season, and how the gap changes."""
    attempts = totals.groupBy("season_id").agg(
        mean_of_parts("fta", _at_home()).alias("home"),
        mean_of_parts("fta", _on_road()).alias("road"),
    )
    difference = F.col("home") - F.col("road")
    change = change_from_previous(difference, "season_start_year")
    return (
        attempts.join(star.dim_season, "season_id")
        .select(
            "season_id",
            "season_start_year",
            "era",
            round_half_away(F.col("home"), 2).alias("home_fta"),
            round_half_away(F.col("road"), 2).alias("road_fta"),
            round_half_away(difference, 2).alias("fta_gap"),
            round_half_away(change, 2).alias("yoy_gap_change"),
        )
        .orderBy(*ascending(["season_start_year"]))
    )


def conference_hca(star: Star, totals: DataFrame) -> DataFrame:
    """The home-road gap in win percentage by season and conference."""
    by_conference = (
        totals.join(star.dim_team.select("team_id", "conference"), "team_id")
        .groupBy("season_id", "conference")
        .agg(_home_gap("win").alias("gap"))
    )
    result = by_conference.join(star.dim_season, "season_id").select(
        "season_start_year",
        "season_id",
        "conference",
        round_half_away(F.col("gap"), 4).alias("hca_gap"),
    )
    return _report(result, "season_start_year", "conference")


def opponent_strength(star: Star, totals: DataFrame) -> DataFrame:
    """Home teams' results by the opponent's third of the league that season.

    Home games are reduced to one row per opponent and season before they meet the tiers.
    """
    strength = totals.groupBy("team_id", "season_id").agg(mean_of_parts("win").alias("season_w_pct"))
    tiers = with_tier(
        strength,
        3,
        keys=["season_id"],
        value="season_w_pct",
        tie_break="team_id",
        name="tier",
    )
    hosted = (
        star.fact_team_game.filter(_at_home() & F.col("opponent_team_id").isNotNull())
        .groupBy(F.col("opponent_team_id").alias("team_id"), "season_id")
        .agg(*parts("win", _win()), F.count(F.lit(1)).alias("games"))
    )
    by_tier = (
        hosted.join(tiers, ["team_id", "season_id"])
        .groupBy("tier")
        .agg(
            round_half_away(mean_of_parts("win"), 4).alias("home_w_pct"),
            F.sum("games").alias("games"),
        )
    )
    label = F.lit(None).cast("string")
    for tier, text in TIER_LABELS.items():
        label = F.when(F.col("tier") == tier, text).otherwise(label)
    return _report(by_tier, "tier").select(
        label.alias("opponent_tier"), "home_w_pct", "games"
    )


def turnover_comfort(star: Star, totals: DataFrame) -> DataFrame:
    """Fewer turnovers and more wins at home by team, each with its own rank."""
    by_team = totals.groupBy("team_id").agg(
        (mean_of_parts("tov", _on_road()) - mean_of_parts("tov", _at_home())).alias("tov_gap"),
        _home_gap("win").alias("win_gap"),
    )
    teams = star.dim_team.select("team_id", "full_name", "conference")
    ranked = with_ranks(
        by_team.join(teams, "team_id"),
        {"tov_rank": "tov_gap", "w_pct_rank": "win_gap"},
    )
    return ranked.select(
        "full_name",
        "conference",
        round_half_away(F.col("tov_gap"), 2).alias("tov_differential"),
        round_half_away(F.col("win_gap"), 4).alias("w_pct_differential"),
        "tov_rank",
        "w_pct_rank",
    ).orderBy(*ascending(["tov_rank"]))


@dataclass(frozen=True)
class Analysis:
    """One question: its theme, its plan, and what its rows are sorted by (SQL expressions, NULLs last).

    ``totals_by`` and ``measures`` name what it needs of :func:`side_totals`.
    """

    theme: str
    plan: Callable[..., DataFrame]
    order: tuple[str, ...]
    totals_by: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()

    def run(self, star: Star, totals: DataFrame | None = None) -> DataFrame:
        """The result; ``totals`` are the :func:`side_totals` of ``star`` if already at hand.

        An analysis run by itself reduces the facts to the keys it needs.
        """
        if not self.totals_by:
            return self.plan(star)
        if totals is None:
            totals = side_totals(star, self.totals_by, self.measures)
        return self.plan(star, totals)


# From the strongest opponents to the weakest.
_BY_TIER = f"array_position(array({', '.join(map(repr, TIER_LABELS.values()))}), opponent_tier)"
_TEAM, _SEASON, _BOTH = ("team_id",), ("season_id",), ("team_id", "season_id")

ANALYSES = {
    "q1_baseline_win_pct": Analysis("baseline", baseline_win_pct, ("season_start_year", "location")),
    "q2_hca_trend": Analysis("trend", hca_trend, ("season_start_year",)),
    "q3_covid_bubble": Analysis(
        "natural_experiments", covid_bubble, ("era", "is_bubble", "is_home"), _SEASON, ("win", "margin")
    ),
    "q4_back_to_back": Analysis("scheduling", back_to_back, ("rest_bucket", "is_home")),
    "q5_shooting_boost": Analysis("performance", shooting_boost, ("fg3_boost_rank",), _TEAM, ("fg_pct", "fg3_pct")),
    "q6_rolling_home_win_pct": Analysis("performance", rolling_home_win_pct, ("team_id", "season_id", "game_date")),
    "q7_referee_bias": Analysis("scheduling", referee_bias, ("season_start_year",), _SEASON, ("fta",)),
    "q8_conference_hca": Analysis("context", conference_hca, ("season_start_year", "conference"), _BOTH, ("win",)),
    "q9_opponent_strength": Analysis("context", opponent_strength, (_BY_TIER,), _BOTH, ("win",)),
    "q10_turnover_comfort": Analysis("performance", turnover_comfort, ("tov_rank",), _TEAM, ("tov", "win")),
}
