"""Staging tables derived from the ``orders`` and ``customer`` tables.

One order becomes one game (two team rows), so the work grows with the tables. The text is the
same for both engines: put ``WITH`` before it and a ``SELECT`` after it.

How games are laid out: the order key gives the season (``% 29``) and a slot; 15 games make a
round by the circle method, so no team plays twice on one date of a season. A block of 30 teams
plays at most 1,024 rounds per season; further rounds go to the next 30 teams, so that dates and
the rows of one team and season stay bounded however many orders there are. Game ids are padded
to seven digits and keep all digits when there are more. Every customer belongs to the team that
its key gives modulo the number of teams; a team's attributes are the smallest of its customers'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.functions.season import EAST_TEAMS, season_label

#: Abbreviations of the teams outside the eastern conference (fixed values).
WEST_TEAMS = (
    "DAL", "DEN", "GSW", "HOU", "LAC", "LAL", "MEM", "MIN", "NOP", "OKC", "PHX", "POR", "SAC", "SAS", "UTA",
)

ROUNDS_PER_BLOCK = 1024
ORDERS_PER_BLOCK = 29 * 15 * ROUNDS_PER_BLOCK

_LOG_AND_TEAMS = """
g0 AS (SELECT o_orderkey AS k, o_custkey AS c, 1996 + CAST(o_orderkey % 29 AS INT) AS y,
       CAST((o_orderkey - o_orderkey % 29) / 29 AS BIGINT) AS i FROM @orders),
g1 AS (SELECT k, c, y, CAST(i % 15 AS INT) AS p,
       CAST(((i - i % 15) / 15) % @rounds AS INT) AS r,
       CAST((k - k % @block) / @block AS INT) AS blk FROM g0),
g2 AS (SELECT k, c, y, r,
       30 * blk + CASE WHEN p = 0 THEN 29 ELSE (r + p) % 29 END AS a,
       30 * blk + CASE WHEN p = 0 THEN r % 29 ELSE (r + 29 * 15 - p) % 29 END AS b,
       CASE WHEN y = 2019 AND r >= 2 THEN make_date(2020,7,30) + CAST(r - 2 AS INT)
            ELSE make_date(y,11,1) + CAST(r + (r - r % 3) / 3 + 2 * (r - r % 7) / 7 AS INT) END AS d FROM g1),
g3 AS (SELECT k, y, d, CASE WHEN c % 2 = 0 THEN a ELSE b END AS h, CASE WHEN c % 2 = 0 THEN b ELSE a END AS v,
       CAST(82 + (k * 7919 + c * 31) % 61 AS INT) AS hp0, CAST(80 + (k * 10473 + c * 17) % 61 AS INT) AS vp, c FROM g2),
g4 AS (SELECT k, y, d, h, v, c, vp, CASE WHEN hp0 = vp THEN hp0 + 1 ELSE hp0 END AS hp FROM g3),
g5 AS (SELECT k, y, d, h AS t, v AS o, hp AS pts, vp AS opts, 1 AS s, c FROM g4
       UNION ALL SELECT k, y, d, v, h, vp, hp, 0, c FROM g4 WHERE k % 997 <> 0),
g6 AS (SELECT k, y, d, t, o, s, c, pts, opts,
       CAST(30 + (k * 13 + t) % 20 AS INT) AS fgm, CAST(75 + (k * 17 + t * 3) % 25 AS INT) AS fga,
       CAST(5 + (k * 11 + t) % 12 AS INT) AS fg3m, CAST(CASE WHEN k % 211 = 0 THEN 0 ELSE 20 + (k * 19 + t) % 20 END AS INT) AS fg3a,
       CAST(10 + (k * 7 + t) % 5 AS INT) AS ftm, CAST(15 + s + (k * 23 + t) % 20 AS INT) AS fta,
       CAST(5 + (k * 3 + t) % 12 AS INT) AS oreb, CAST(25 + (k * 5 + t) % 15 AS INT) AS dreb,
       CAST(15 + (k * 31 + t) % 18 AS INT) AS ast, CAST(3 + (k * 37 + t) % 9 AS INT) AS stl,
       CAST(1 + (k * 41 + t) % 9 AS INT) AS blk, CAST(9 - s + (k * 29 + t) % 12 AS INT) AS tov,
       CAST(14 + (k * 43 + t) % 13 AS INT) AS pf FROM g5),
staging_game_log AS (SELECT CONCAT('2', CAST(y AS STRING)) AS season_id, CAST(1610612737 + t AS INT) AS team_id,
       CONCAT('002', CASE WHEN k < 10000000 THEN LPAD(CAST(k AS STRING), 7, '0') ELSE CAST(k AS STRING) END) AS game_id,
       CAST(d AS STRING) AS game_date,
       CONCAT('T', CAST(t AS STRING), CASE WHEN s = 1 THEN ' vs. T' ELSE ' @ T' END, CAST(o AS STRING)) AS matchup,
       CASE WHEN k % 1009 = 0 THEN NULL WHEN pts > opts THEN 'W' ELSE 'L' END AS wl, pts,
       fgm, fga, CAST(fgm AS DOUBLE) / CAST(fga AS DOUBLE) AS fg_pct,
       CASE WHEN fg3a = 0 THEN 0 ELSE fg3m END AS fg3m, fg3a,
       CASE WHEN fg3a = 0 THEN NULL ELSE CAST(fg3m AS DOUBLE) / CAST(fg3a AS DOUBLE) END AS fg3_pct,
       ftm, fta, CAST(ftm AS DOUBLE) / CAST(fta AS DOUBLE) AS ft_pct,
       oreb, dreb, oreb + dreb AS reb, ast, stl, blk, tov, pf, CAST(pts - opts AS DOUBLE) AS plus_minus FROM g6),
team_count AS (SELECT 30 + 30 * CAST((MAX(o_orderkey) - MAX(o_orderkey) % @block) / @block AS BIGINT) AS n FROM @orders),
customers AS (SELECT CAST(c_custkey % (SELECT n FROM team_count) AS INT) AS t, c_name, c_mktsegment, c_nationkey FROM @customer),
teams AS (SELECT t, MIN(c_name) AS name, MIN(c_mktsegment) AS segment, MIN(c_nationkey) AS nation FROM customers GROUP BY t),
staging_teams AS (SELECT CAST(1610612737 + t AS INT) AS id, CONCAT('Team ', name) AS full_name,
       substring('@teams', 3*(t % 30)+1, 3) AS abbreviation,
       segment AS nickname, CONCAT('City ', CAST(nation AS STRING)) AS city, CONCAT('State ', CAST(nation % 5 AS STRING)) AS state,
       CAST(1946 + t % 30 AS INT) AS year_founded
       FROM teams)
"""

_STATS = """
stats_totals AS (SELECT team_id, @season AS season,
       CASE WHEN matchup LIKE '%vs.%' THEN 'Home' ELSE 'Road' END AS location,
       CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(CASE WHEN wl='W' THEN 1 ELSE 0 END) AS INT) AS w,
       CAST(SUM(CASE WHEN wl='L' THEN 1 ELSE 0 END) AS INT) AS l,
       CAST(SUM(pts) AS DOUBLE) AS pts, CAST(SUM(fga) AS DOUBLE) AS fga, CAST(SUM(fgm) AS DOUBLE) AS fgm,
       CAST(SUM(tov) AS DOUBLE) AS tov, SUM(plus_minus) AS plus_minus
       FROM @log GROUP BY team_id, season_id, CASE WHEN matchup LIKE '%vs.%' THEN 'Home' ELSE 'Road' END),
staging_team_stats_base AS (SELECT team_id, season, location, CAST(n AS INT) AS gp, w, l, CAST(w AS DOUBLE) / n AS w_pct
       FROM stats_totals),
staging_team_stats_advanced AS (SELECT team_id, season, location,
       100e0*pts/fga AS off_rating, (100e0*pts-100e0*plus_minus)/fga AS def_rating, 100e0*plus_minus/fga AS net_rating,
       (fga+tov)/n AS pace, fgm/fga AS pie
       FROM stats_totals)
"""


def _log_and_teams_sql(orders: str, customer: str) -> str:
    return (
        _LOG_AND_TEAMS.replace("@orders", orders)
        .replace("@customer", customer)
        .replace("@rounds", str(ROUNDS_PER_BLOCK))
        .replace("@block", str(ORDERS_PER_BLOCK))
        .replace("@teams", "".join((*EAST_TEAMS, *WEST_TEAMS)))
    )


def staging_sql(season: str) -> str:
    """The staging tables as a list of named subqueries over ``orders`` and ``customer``.

    ``season`` is the SQL of a season's label from ``season_id``.
    """
    stats = _STATS.replace("@log", "staging_game_log").replace("@season", season)
    return ",".join([_log_and_teams_sql("orders", "customer"), stats])


def derive_log_and_teams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The game log and the teams, from the Parquet tables in ``sf_dir``."""
    tables = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "customer")
    }
    with_clause = "WITH " + _log_and_teams_sql("{orders}", "{customer}")
    return (
        spark.sql(f"{with_clause} SELECT * FROM staging_game_log", **tables),
        spark.sql(f"{with_clause} SELECT * FROM staging_teams", **tables),
    )


def derive_stats(spark: SparkSession, game_log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The base and the advanced season stats of a game log."""
    with_clause = "WITH " + _STATS.replace("@log", "{game_log}").replace("@season", "season_id")

    def labelled(table: str) -> DataFrame:
        rows = spark.sql(f"{with_clause} SELECT * FROM {table}", game_log=game_log)
        return rows.withColumn("season", season_label(F.col("season")))

    return labelled("staging_team_stats_base"), labelled("staging_team_stats_advanced")
