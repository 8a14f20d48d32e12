"""Expected results by query key."""

from __future__ import annotations

from oracle.star_sql import over_staging, over_star

# The ten analyses, over the star schema.
_ANALYSES = {
    "q1_baseline_win_pct": """
        SELECT season_start_year, season_id, era, location, round(avg(w_pct), 4) AS avg_w_pct
        FROM dim_season JOIN fact_team_season USING (season_id) GROUP BY ALL""",
    "q2_hca_trend": """
        SELECT season_start_year, season_id, era, round(raw_gap, 4) AS hca_gap,
               round(raw_gap - lag(raw_gap) OVER (ORDER BY season_start_year), 4) AS yoy_change
        FROM (SELECT season_start_year, season_id, era,
                     avg(w_pct) FILTER (location = 'Home') - avg(w_pct) FILTER (location = 'Road') AS raw_gap
              FROM dim_season JOIN fact_team_season USING (season_id) GROUP BY ALL)""",
    "q3_covid_bubble": """
        SELECT era, is_bubble, is_home, round(avg(win), 4) AS w_pct,
               round(avg(plus_minus), 2) AS avg_plus_minus, count(*) AS games
        FROM results JOIN dim_season USING (season_id)
        JOIN (SELECT game_id, is_bubble FROM dim_game) USING (game_id) GROUP BY ALL""",
    "q4_back_to_back": """
        SELECT if(is_back_to_back, 'Back-to-Back', if(rest_days >= 3, 'Well Rested', 'Normal Rest')) AS rest_bucket,
               is_home, round(avg(win), 4) AS w_pct, count(*) AS games
        FROM results WHERE rest_days IS NOT NULL GROUP BY ALL""",
    "q5_shooting_boost": """
        SELECT full_name, conference, round(fg, 4) AS fg_pct_boost, round(fg3, 4) AS fg3_pct_boost,
               rank() OVER (ORDER BY fg3 DESC) AS fg3_boost_rank
        FROM (SELECT team_id, avg(fg_pct) FILTER (is_home) - avg(fg_pct) FILTER (NOT is_home) AS fg,
                     avg(fg3_pct) FILTER (is_home) - avg(fg3_pct) FILTER (NOT is_home) AS fg3
              FROM results GROUP BY team_id) JOIN dim_team USING (team_id)""",
    "q6_rolling_home_win_pct": """
        SELECT team_id, full_name, season_id, game_date, month,
               round(avg(win) OVER (PARTITION BY team_id, season_id ORDER BY game_date, game_id
                                    ROWS 9 PRECEDING), 4) AS rolling_10_home_w_pct
        FROM results JOIN (SELECT game_id, game_date, month FROM dim_game) USING (game_id)
        JOIN dim_team USING (team_id) WHERE is_home""",
    "q7_referee_bias": """
        SELECT season_id, season_start_year, era, round(home, 2) AS home_fta, round(road, 2) AS road_fta,
               round(home - road, 2) AS fta_gap,
               round(home - road - lag(home - road) OVER (ORDER BY season_start_year), 2) AS yoy_gap_change
        FROM (SELECT season_id, avg(fta) FILTER (is_home) AS home, avg(fta) FILTER (NOT is_home) AS road
              FROM results GROUP BY season_id) JOIN dim_season USING (season_id)""",
    "q8_conference_hca": """
        SELECT season_start_year, season_id, conference,
               round(avg(win) FILTER (is_home) - avg(win) FILTER (NOT is_home), 4) AS hca_gap
        FROM results JOIN dim_team USING (team_id) JOIN dim_season USING (season_id) GROUP BY ALL""",
    "q9_opponent_strength": """
        SELECT ['Top Third', 'Middle Third', 'Bottom Third'][tier] AS opponent_tier,
               round(avg(win), 4) AS home_w_pct, count(*) AS games
        FROM results JOIN (
            SELECT team_id AS opponent_team_id, season_id,
                   ntile(3) OVER (PARTITION BY season_id ORDER BY avg(win) DESC, team_id) AS tier
            FROM results GROUP BY team_id, season_id) USING (opponent_team_id, season_id)
        WHERE is_home GROUP BY tier""",
    "q10_turnover_comfort": """
        SELECT full_name, conference, round(tov_gap, 2) AS tov_differential,
               round(win_gap, 4) AS w_pct_differential,
               rank() OVER (ORDER BY tov_gap DESC) AS tov_rank,
               rank() OVER (ORDER BY win_gap DESC) AS w_pct_rank
        FROM (SELECT team_id, avg(tov) FILTER (NOT is_home) - avg(tov) FILTER (is_home) AS tov_gap,
                     avg(win) FILTER (is_home) - avg(win) FILTER (NOT is_home) AS win_gap
              FROM results GROUP BY team_id) JOIN dim_team USING (team_id)""",
}

_THEMES = {
    "q1_baseline_win_pct": "baseline",
    "q2_hca_trend": "trend",
    "q3_covid_bubble": "natural_experiments",
    "q4_back_to_back": "scheduling",
    "q5_shooting_boost": "performance",
    "q6_rolling_home_win_pct": "performance",
    "q7_referee_bias": "scheduling",
    "q8_conference_hca": "context",
    "q9_opponent_strength": "context",
    "q10_turnover_comfort": "performance",
}

_TABLES = ("dim_team", "dim_season", "dim_game", "fact_team_game", "fact_team_season")
_STAGING = ("teams", "game_log", "team_stats_base", "team_stats_advanced")

_OVER_STAR = {
    **_ANALYSES,
    **{table: f"SELECT * FROM {table}" for table in _TABLES},
    "opponent_join": """
        SELECT game_id, mine.team_id, theirs.team_id AS opponent_team_id, theirs.pts AS opp_pts
        FROM log AS mine LEFT JOIN log AS theirs USING (game_id)
        WHERE mine.team_id <> theirs.team_id
        UNION ALL
        SELECT game_id, min(team_id), NULL, NULL FROM log GROUP BY game_id HAVING count(*) = 1""",
    "rest_days": """
        SELECT game_id, team_id, rest_days, coalesce(rest_days = 1, false) AS is_back_to_back
        FROM previous""",
    "season_label": """
        SELECT season_id AS raw_season_id, label AS season_id, count(*) AS team_games
        FROM log GROUP BY ALL""",
    "cond_avg": """
        SELECT season_id, avg(pts) FILTER (wl = 'W') AS pts_in_wins, avg(pts) FILTER (rest_days = 1) AS pts_tired
        FROM results GROUP BY season_id""",
    "gap": """
        SELECT team_id, avg(pts) FILTER (is_home) - avg(pts) FILTER (NOT is_home) AS pts_gap
        FROM results GROUP BY team_id""",
    "yoy_change": """
        SELECT season_start_year, avg(pts) AS avg_pts,
               avg(pts) - lag(avg(pts)) OVER (ORDER BY season_start_year) AS yoy_change
        FROM results JOIN dim_season USING (season_id) GROUP BY season_start_year""",
    "tier": """
        SELECT team_id, season_id, avg(win) AS season_w_pct,
               (ntile(3) OVER (PARTITION BY season_id ORDER BY avg(win) DESC, team_id))::INT AS tier
        FROM results GROUP BY team_id, season_id""",
    "rank": """
        SELECT team_id, sum(win)::BIGINT AS wins, rank() OVER (ORDER BY sum(win) DESC) AS win_rank
        FROM results GROUP BY team_id""",
    "rolling_mean": """
        SELECT game_id, team_id, avg(pts) OVER (
                   PARTITION BY team_id, season_id ORDER BY day, game_id ROWS 9 PRECEDING) AS rolling_pts
        FROM log""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
        for name, source in [
            *[(table, f"staging_{table}") for table in _STAGING],
            *[(table, table) for table in _TABLES],
        ]
    ),
    "dq_star": """
        SELECT rule, violations FROM (
          WITH teams AS (
            SELECT * FROM dim_team WHERE abbreviation <> 'DEN'
            UNION ALL SELECT * FROM dim_team WHERE conference = 'East'),
          seasons AS (
            SELECT season_id, nullif(era, 'Schedule Reform') AS era FROM dim_season WHERE NOT is_lockout
            UNION ALL SELECT season_id, era FROM dim_season WHERE is_covid),
          games AS (
            SELECT game_id, if(day_of_week = 'Tuesday', NULL, game_date) AS game_date FROM dim_game
            WHERE day_of_week <> 'Monday'
            UNION ALL SELECT game_id, game_date FROM dim_game WHERE day_of_week = 'Sunday'),
          facts AS (
            SELECT game_id, team_id, opponent_team_id, season_id FROM results
            UNION ALL SELECT game_id, team_id, opponent_team_id, season_id FROM results WHERE rest_days >= 4
            UNION ALL SELECT game_id, -team_id, opponent_team_id, season_id FROM results WHERE pts >= 130),
          stats AS (
            SELECT team_id, season_id, location FROM fact_team_season
            UNION ALL SELECT team_id, season_id, location FROM fact_team_season
            WHERE location = 'Home' AND w > l)
          SELECT * FROM (VALUES
            ('dim_team key', (SELECT count(*) FROM (SELECT team_id FROM teams GROUP BY ALL HAVING count(*) > 1))),
            ('dim_season key', (SELECT count(*) FROM (
                 SELECT season_id FROM seasons GROUP BY ALL HAVING count(*) > 1))),
            ('dim_season required', (SELECT count(DISTINCT season_id) FROM seasons WHERE era IS NULL)),
            ('dim_game key', (SELECT count(*) FROM (SELECT game_id FROM games GROUP BY ALL HAVING count(*) > 1))),
            ('dim_game required', (SELECT count(DISTINCT game_id) FROM games WHERE game_date IS NULL)),
            ('fact_team_game key', (SELECT count(DISTINCT game_id) FROM (
                 SELECT game_id, team_id FROM facts GROUP BY ALL HAVING count(*) > 1))),
            ('fact_team_game sides', (SELECT count(*) FROM (
                 SELECT game_id FROM facts GROUP BY ALL HAVING count(*) > 2))),
            ('fact_team_game game', (SELECT count(DISTINCT game_id) FROM facts ANTI JOIN games USING (game_id))),
            ('fact_team_game team', (SELECT count(DISTINCT team_id) FROM facts ANTI JOIN teams USING (team_id))),
            ('fact_team_game opponent', (SELECT count(DISTINCT opponent_team_id) FROM facts
                 WHERE opponent_team_id NOT IN (SELECT team_id FROM teams))),
            ('fact_team_game season', (SELECT count(DISTINCT season_id) FROM facts
                 ANTI JOIN seasons USING (season_id))),
            ('fact_team_season key', (SELECT count(*) FROM (
                 SELECT team_id, season_id, location FROM stats GROUP BY ALL HAVING count(*) > 1))),
            ('fact_team_season team', (SELECT count(DISTINCT team_id) FROM stats ANTI JOIN teams USING (team_id))),
            ('fact_team_season season', (SELECT count(DISTINCT season_id) FROM stats
                 ANTI JOIN seasons USING (season_id)))
          ) AS checks(rule, violations))""",
    "export_roundtrip": _ANALYSES["q4_back_to_back"],
    "export_order": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, 0::BIGINT AS out_of_order FROM ({query})"
        for name, query in _ANALYSES.items()
    ),
    "staging_roundtrip": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS written, count(*) = 0 AS is_empty "
        f"FROM staging_{name} WHERE {'team_id IS NULL' if name == 'team_stats_advanced' else 'true'}"
        for name in _STAGING
    ),
    "export_catalog": " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{_THEMES[name]}' AS theme, count(*) AS rows FROM ({query})"
        for name, query in _ANALYSES.items()
    ),
}

_OVER_STAGING = {
    "stg_teams": "SELECT * FROM staging_teams",
    "stg_game_log": "SELECT * FROM staging_game_log",
    "stg_team_stats": """
        SELECT team_id, season, location, gp, w, l, w_pct,
               NULL::DOUBLE AS off_rating, NULL::DOUBLE AS def_rating, NULL::DOUBLE AS net_rating,
               NULL::DOUBLE AS pace, NULL::DOUBLE AS pie FROM staging_team_stats_base
        UNION ALL BY NAME SELECT * FROM staging_team_stats_advanced""",
    "dq_not_null": """
        SELECT column_name, null_rows FROM (
            UNPIVOT (SELECT count(*) - count(wl) AS wl, count(*) - count(fg3_pct) AS fg3_pct,
                            count(*) - count(pts) AS pts FROM staging_game_log)
            ON wl, fg3_pct, pts INTO NAME column_name VALUE null_rows)
        WHERE null_rows > 0""",
}

# Operators on tables that have nothing to do with games.
_OVER_TABLES = {
    "cond_avg_lineitem": """
        SELECT l_returnflag, l_linestatus, avg(l_quantity) FILTER (l_discount > 0.05) AS discounted_quantity
        FROM lineitem GROUP BY ALL""",
    "days_since_previous_events": """
        SELECT event_id, user_id,
               (ts::DATE - lag(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id))::INT AS days_since
        FROM events""",
    "rolling_mean_events": """
        SELECT event_id, user_id, round(avg(value) OVER (
                   PARTITION BY user_id ORDER BY ts, event_id ROWS 9 PRECEDING), 4) AS rolling_value
        FROM events""",
    "dq_primary_key": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "dq_foreign_key": """
        SELECT doc_id, count(*) AS rows FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
}


def expected() -> dict[str, str]:
    return {
        **{key: over_star(query) for key, query in _OVER_STAR.items()},
        **{key: over_staging(query) for key, query in _OVER_STAGING.items()},
        **_OVER_TABLES,
        **{f"{key}_spread": over_star(_OVER_STAR[key]) for key in ("tier", "rank")},
        **{f"{key}_hot": _OVER_TABLES[key] for key in ("days_since_previous_events", "rolling_mean_events")},
    }
