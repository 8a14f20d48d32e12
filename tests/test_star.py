"""Star builders, analyses and checks on a few hand-written games."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from hardwood.operators.opponents import crowded_events, with_opponent
from hardwood.sources.derived import derive_log_and_teams
from hardwood.operators.quality import (
    foreign_key_violations,
    not_null_violations,
    primary_key_violations,
    row_counts,
)
from hardwood.plans import star as plans
from hardwood.plans.analyses import ANALYSES
from hardwood.plans.star import (
    ConstraintViolation,
    Staging,
    Star,
    build_star,
    create_views,
    require_valid,
)
from hardwood.sources import schemas


def team_game(game, team, other, date, pts, home=True, wl="W", season="21999", **given):
    box = {
        field.name: 1.0 if field.dataType.simpleString() == "double" else 10
        for field in schemas.STAGING_GAME_LOG.fields
    }
    return {
        **box,
        "season_id": season,
        "team_id": team,
        "game_id": game,
        "game_date": date,
        "matchup": f"T{team} {'vs.' if home else '@'} T{other}",
        "wl": wl,
        "pts": pts,
        **given,
    }


def log_of(spark, *games):
    names = schemas.STAGING_GAME_LOG.names
    return spark.createDataFrame(
        [tuple(game[name] for name in names) for game in games], schemas.STAGING_GAME_LOG
    )


def teams_of(spark, *rows):
    return spark.createDataFrame(
        [(i, f"Team {i}", a, "nick", "city", "state", 1950) for i, a in rows],
        schemas.STAGING_TEAMS,
    )


@pytest.fixture
def games(spark):
    return log_of(
        spark,
        team_game("0029900001", 1, 2, "1999-11-02", 100, plus_minus=2.5, fg3_pct=None),
        team_game("0029900001", 2, 1, "1999-11-02", 90, home=False, wl="L", plus_minus=-12.6),
        team_game("0029900002", 1, 3, "1999-11-03", 80, home=False, wl=None),
        team_game("0029900003", 1, 2, "1999-11-07", 70, wl="L"),
        team_game("0029900003", 2, 1, "1999-11-07", 75, home=False),
        team_game("0020000001", 1, 2, "2000-11-01", 60, season="22000"),
        team_game("0020000001", 2, 1, "2000-11-01", 50, home=False, wl="L", season="22000"),
    )


@pytest.fixture
def staging(spark, games):
    base = spark.createDataFrame(
        [(1, "1999-00", "Home", 2, 1, 1, 0.5), (2, "1999-00", "Road", 2, 1, 1, 0.5)],
        schemas.STAGING_STATS_BASE,
    )
    advanced = spark.createDataFrame(
        [(1, "1999-00", "Home", 1.0, 2.0, 3.0, 4.0, 0.5)], schemas.STAGING_STATS_ADVANCED
    )
    return Staging(teams_of(spark, (1, "BOS"), (2, "LAL"), (3, None)), games, base, advanced)


def facts(df):
    return {(row.game_id, row.team_id): row for row in plans.fact_team_game(df).collect()}


def test_fact_team_game(games):
    rows = facts(games)
    assert len(rows) == 7
    first = rows["0029900001", 1]
    assert (first.opponent_team_id, first.opp_pts, first.is_home) == (2, 90, True)
    assert (first.rest_days, first.is_back_to_back) == (None, False)
    assert (first.plus_minus, first.season_id, first.fg3_pct) == (2, "1999-00", None)
    assert rows["0029900001", 2].plus_minus == -13
    lone = rows["0029900002", 1]
    assert (lone.opponent_team_id, lone.opp_pts) == (None, None)
    assert (lone.rest_days, lone.is_back_to_back) == (1, True)
    assert (rows["0029900003", 1].rest_days, rows["0029900003", 1].is_back_to_back) == (4, False)
    assert rows["0029900003", 2].rest_days == 5
    assert rows["0020000001", 1].rest_days is None, "a new season starts without rest"


def test_fact_team_game_with_hot_teams(games):
    plain = plans.fact_team_game(games)
    split = plans.fact_team_game(games, rows_per_task=1)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert split.dtypes == plain.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.FACT_TEAM_GAME.fields]


def test_rest_follows_the_raw_season(spark):
    """Two raw ids of one year are separate seasons for rest, as their type differs."""
    rows = facts(
        log_of(
            spark,
            team_game("a", 1, 2, "1999-11-02", 1, season="21999"),
            team_game("b", 1, 2, "1999-11-03", 1, season="41999"),
        )
    )
    assert rows["b", 1].rest_days is None
    assert rows["a", 1].season_id == rows["b", 1].season_id == "1999-00"


def test_missing_matchup_is_not_home(spark):
    log = log_of(spark, team_game("a", 1, 2, "1999-11-02", 1, matchup=None))
    assert facts(log)["a", 1].is_home is False


def test_dim_game(games):
    rows = {row.game_id: row for row in plans.dim_game(games).collect()}
    assert len(rows) == 4
    assert rows["0029900001"] == Row(
        game_id="0029900001",
        game_date=datetime.date(1999, 11, 2),
        month=11,
        day_of_week="Tuesday",
        season_id="1999-00",
        is_bubble=False,
    )


def test_dim_season_merges_season_types(spark):
    log = log_of(
        spark,
        team_game("a", 1, 2, "2019-11-02", 1, season="22019"),
        team_game("b", 1, 2, "2020-05-02", 1, season="42019"),
    )
    assert [tuple(row) for row in plans.dim_season(log).collect()] == [
        ("2019-20", 2019, "COVID Bubble", 75, False, True)
    ]


def test_dim_team(staging):
    found = {row.team_id: row.conference for row in plans.dim_team(staging.teams).collect()}
    assert found == {1: "East", 2: "West", 3: "West"}


def test_fact_team_season_is_an_inner_join(staging):
    rows = plans.fact_team_season(staging.team_stats_base, staging.team_stats_advanced).collect()
    assert [(row.team_id, row.location, row.season_id, row.gp) for row in rows] == [
        (1, "Home", "1999-00", 2)
    ]


def test_valid_star_passes(staging):
    require_valid(build_star(staging))


def broken(staging, **changes):
    changed = Staging(**{**staging.__dict__, **changes})
    return build_star(changed)


def test_third_team_in_a_game_is_refused(spark, staging):
    extra = log_of(spark, team_game("0029900001", 3, 1, "1999-11-02", 5, home=False))
    with pytest.raises(ConstraintViolation, match="sides"):
        require_valid(broken(staging, game_log=staging.game_log.union(extra)))


def test_repeated_row_is_refused(staging):
    with pytest.raises(ConstraintViolation, match="fact_team_game key"):
        require_valid(broken(staging, game_log=staging.game_log.union(staging.game_log.limit(1))))


def test_season_without_era_is_refused(spark, staging):
    late = log_of(spark, team_game("x", 1, 2, "2025-11-02", 5, season="22025"))
    with pytest.raises(ConstraintViolation, match="dim_season required.*era"):
        require_valid(broken(staging, game_log=staging.game_log.union(late)))


def test_unknown_team_is_refused(spark, staging):
    with pytest.raises(ConstraintViolation, match="fact_team_game team"):
        require_valid(broken(staging, teams=teams_of(spark, (2, "LAL"), (3, "NYK"))))


def test_opponent_join_keeps_null_sides(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, None), ("b", None, 5), ("b", 3, 6), (None, 4, 7), (None, 5, 8)],
        "event string, side int, score int",
    )
    found = with_opponent(df, "event", "side", "other", {"score": "other_score"}).collect()
    assert {tuple(row) for row in found} == {
        ("a", 1, 10, 2, None),
        ("a", 2, None, 1, 10),
        ("b", None, 5, None, None),
        ("b", 3, 6, None, None),
        (None, 4, 7, None, None),
        (None, 5, 8, None, None),
    }
    assert crowded_events(df, "event").collect() == []


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, "c"), (2, None)], "id int, name string"
    )
    assert {tuple(r) for r in primary_key_violations(df, ["id"]).collect()} == {(1, 2), (None, 1)}
    assert primary_key_violations(df, ["id", "name"]).count() == 2
    parent = spark.createDataFrame([(2,)], "key int")
    assert [tuple(r) for r in foreign_key_violations(df, "id", parent, "key").collect()] == [(1, 2)]
    nulls = not_null_violations(df, ["id", "name"]).collect()
    assert {tuple(row) for row in nulls} == {("id", 1), ("name", 1)}
    counts = row_counts({"all": df, "none": df.filter("false")}).collect()
    assert {tuple(row) for row in counts} == {("all", 4), ("none", 0)}


def test_star_answers_sql(spark, staging):
    create_views(build_star(staging))
    found = spark.sql(
        "SELECT full_name, count(*) AS games FROM fact_team_game JOIN dim_team USING (team_id) "
        "JOIN dim_season USING (season_id) WHERE season_start_year = 1999 GROUP BY full_name"
    )
    assert {tuple(row) for row in found.collect()} == {("Team 1", 3), ("Team 2", 2)}


def test_null_result_counts_as_a_loss(staging):
    star = build_star(staging)
    rows = {(r.rest_bucket, r.is_home): r for r in ANALYSES["q4_back_to_back"].run(star).collect()}
    assert rows["Back-to-Back", False].w_pct == 0.0
    assert (rows["Well Rested", True].games, rows["Well Rested", True].w_pct) == (1, 0.0)


def test_rolling_frame_is_short_at_first_and_restarts_each_season(spark, staging):
    results = ["W", "L", "W"] + ["L"] * 9
    games = [
        team_game(f"g{n:02}", 1, 2, f"1999-12-{n + 1:02}", 1, wl=result)
        for n, result in enumerate(results)
    ] + [team_game("h", 1, 2, "2000-12-01", 1, season="22000")]
    changed = Staging(**{**staging.__dict__, "game_log": log_of(spark, *games)})
    rows = ANALYSES["q6_rolling_home_win_pct"].run(build_star(changed)).collect()
    assert [r.rolling_10_home_w_pct for r in rows] == [
        1.0, 0.5, 0.6667, 0.5, 0.4, 0.3333, 0.2857, 0.25, 0.2222, 0.2, 0.1, 0.1, 1.0,
    ]
    assert rows[0].full_name == "Team 1" and rows[0].month == 12


def test_ranks_share_ties(spark, staging):
    star = build_star(staging)
    tied = spark.createDataFrame(
        [(t, home, tov) for t, high in ((1, 9), (2, 9), (3, 5)) for home, tov in ((True, 4), (False, high))],
        "team_id int, is_home boolean, tov int",
    ).withColumn("wl", F.lit("W"))
    star = Star(**{**star.__dict__, "fact_team_game": tied})
    rows = ANALYSES["q10_turnover_comfort"].run(star).collect()
    assert [(r.tov_differential, r.tov_rank, r.w_pct_rank) for r in rows] == [
        (5.0, 1, 1), (5.0, 1, 1), (1.0, 3, 1),
    ]


def test_a_third_side_raises(spark):
    df = spark.createDataFrame([("e", "a", 1), ("e", "b", 2), ("e", "c", 3)], "event string, side string, score int")
    for wanted in ("other", "other_score"):
        with pytest.raises(Exception, match="more than two rows of event e"):
            with_opponent(df, "event", "side", "other", {"score": "other_score"}).select(wanted).collect()
    assert with_opponent(df, "event", "side", "other", {}).select("score").count() == 3


def test_fixture_beyond_one_block(spark, tmp_path):
    """Order keys of the first and of later blocks: no team plays twice on one date."""
    keys = [*range(1, 3000), *range(445_440, 448_000), *range(890_880, 892_000)]
    orders = spark.createDataFrame([(k, k % 7) for k in keys], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame(
        [(k, f"C{k:04d}", k % 25, "S") for k in range(300)],
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    log, teams = derive_log_and_teams(spark, str(tmp_path))
    assert log.groupBy("team_id", "game_date").count().filter("count > 1").isEmpty()
    assert teams.count() == teams.select("id").distinct().count() == 90
    assert log.join(teams, log.team_id == teams.id, "left_anti").isEmpty()
