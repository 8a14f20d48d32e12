"""The star schema as named subqueries over the derived staging tables."""

from __future__ import annotations

from hardwood.functions import season
from hardwood.sources.derived import staging_sql


_LABEL = "format('{}-{:02d}', substr(season_id, 2)::INT, (substr(season_id, 2)::INT + 1) % 100)"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(value) for value in row) + ")" for row in rows)


_STAR = f"""
log AS (
  SELECT *, substr(season_id, 2)::INT AS start_year, game_date::DATE AS day,
         format('{{}}-{{:02d}}', start_year, (start_year + 1) % 100) AS label
  FROM staging_game_log),
eras(first_year, last_year, era) AS (VALUES {_values(season.ERAS)}),
short_seasons(short_year, games) AS (VALUES {_values(season.SHORT_SEASONS.items())}),
dim_team AS (
  SELECT id AS team_id, full_name, abbreviation, nickname, city, state, year_founded,
         if(list_contains({list(season.EAST_TEAMS)}, abbreviation), 'East', 'West') AS conference
  FROM staging_teams),
dim_season AS (
  SELECT label AS season_id, start_year AS season_start_year, era,
         coalesce(games, {season.USUAL_GAMES}) AS games_in_season,
         list_contains({list(season.LOCKOUT_YEARS)}, start_year) AS is_lockout,
         list_contains({list(season.COVID_YEARS)}, start_year) AS is_covid
  FROM (SELECT label, start_year FROM log GROUP BY ALL)
  LEFT JOIN eras ON start_year BETWEEN first_year AND last_year
  LEFT JOIN short_seasons ON start_year = short_year),
dim_game AS (
  SELECT game_id, day AS game_date, month(day)::INT AS month, strftime(day, '%A') AS day_of_week,
         label AS season_id,
         day >= DATE '{season.BUBBLE_FIRST_DAY}' AND day <= DATE '{season.BUBBLE_LAST_DAY}' AS is_bubble
  FROM log GROUP BY ALL),
previous AS (
  SELECT game_id, team_id,
         (day - lag(day) OVER (PARTITION BY team_id, season_id ORDER BY day))::INT AS rest_days
  FROM log),
fact_team_game AS (
  SELECT mine.game_id, mine.team_id, theirs.team_id AS opponent_team_id, mine.label AS season_id,
         contains(mine.matchup, 'vs.') AS is_home, mine.wl, mine.pts, theirs.pts AS opp_pts,
         mine.fgm, mine.fga, mine.fg_pct::FLOAT AS fg_pct,
         mine.fg3m, mine.fg3a, mine.fg3_pct::FLOAT AS fg3_pct,
         mine.ftm, mine.fta, mine.ft_pct::FLOAT AS ft_pct,
         mine.oreb, mine.dreb, mine.reb, mine.ast, mine.stl, mine.blk, mine.tov, mine.pf,
         mine.plus_minus::INT AS plus_minus, rest_days,
         rest_days IS NOT DISTINCT FROM 1 AS is_back_to_back
  FROM log AS mine
  JOIN previous USING (game_id, team_id)
  LEFT JOIN log AS theirs ON theirs.game_id = mine.game_id AND theirs.team_id <> mine.team_id),
fact_team_season AS (
  SELECT team_id, location, season AS season_id, gp, w, l, w_pct::FLOAT AS w_pct,
         off_rating::FLOAT AS off_rating, def_rating::FLOAT AS def_rating,
         net_rating::FLOAT AS net_rating, pace::FLOAT AS pace, pie::FLOAT AS pie
  FROM staging_team_stats_base JOIN staging_team_stats_advanced USING (team_id, season, location)),
results AS (
  SELECT *, (wl IS NOT DISTINCT FROM 'W')::INT AS win FROM fact_team_game)
"""

_STAGED = "WITH " + staging_sql(_LABEL)


def over_staging(query: str) -> str:
    """``query`` with the staging tables in scope."""
    return f"{_STAGED} {query}"


def over_star(query: str) -> str:
    """``query`` with the staging and star tables in scope."""
    return f"{_STAGED}, {_STAR} {query}"
