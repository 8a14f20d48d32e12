"""

Queries about games first derive the staging tables from ``orders`` and ``customer`` and write
them, then the star schema, to the shared scratch folder: once per session and input folder, as
the full run does. Every query reads whole tables.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable
from dataclasses import fields, replace
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver may load this file by its path from another folder.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from hardwood.functions.compat import round_half_away
from hardwood.functions.season import season_label
from hardwood.operators.metrics import (
    change_from_previous,
    cond_avg,
    gap,
    win_rate,
    with_ranks,
    with_tier,
    won,
)
from hardwood.operators.opponents import with_opponent
from hardwood.operators.quality import (
    foreign_key_violations,
    not_null_violations,
    order_violations,
    primary_key_violations,
    row_counts,
)
from hardwood.operators.windows import days_since_previous, rolling_mean
from hardwood.plans import star as star_plans
from hardwood.plans.analyses import ANALYSES
from hardwood.plans.run import export_all
from hardwood.plans.star import Staging, Star, build_star, require_valid, star_violations
from hardwood.sinks.scratch import keep, scratch_path
from hardwood.sinks.tables import (
    export,
    read_catalog,
    read_result,
    read_staging,
    read_star,
    write_staging,
    write_star,
)
from hardwood.sources import landed
from hardwood.sources.derived import derive_log_and_teams, derive_stats
from oracle.queries_sql import expected

try:  # the text operators and their pipeline are optional
    import corpus_pipeline
    from hardwood.llm import queries as text_queries
    from hardwood.llm import queries_sql as text_sql
except ModuleNotFoundError as missing:
    own = (missing.name or "").split(".")[0] in ("hardwood", "oracle")
    if own and missing.name != "hardwood.llm":
        raise  # a fault of this library
    if missing.name not in ("corpus_pipeline", "hardwood.llm"):
        logging.getLogger(__name__).warning("no text queries: module %s is missing", missing.name)
    corpus_pipeline = text_queries = text_sql = None

Query = Callable[[SparkSession, str], DataFrame]

_prepared: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, prepare: Callable):
    """What ``prepare`` returned, called once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _prepared:
        _prepared[key] = prepare()
    return _prepared[key]


def derive_staging(spark: SparkSession, sf_dir: str) -> Staging:
    """Derive and write the staging tables; the stats are read from the written game log."""
    log, teams = derive_log_and_teams(spark, sf_dir)
    game_log = keep(log, "game_log")
    base, advanced = derive_stats(spark, game_log)
    return Staging(
        teams=keep(teams, "teams"),
        game_log=game_log,
        team_stats_base=keep(base, "team_stats_base"),
        team_stats_advanced=keep(advanced, "team_stats_advanced"),
    )


def write_and_read_star(spark: SparkSession, staging: Staging) -> Star:
    path = scratch_path(spark, "star")
    write_star(build_star(staging), path)
    star = read_star(spark, path)
    require_valid(star)
    return star


def staging_tables(spark: SparkSession, sf_dir: str) -> Staging:
    return _once(spark, sf_dir, "staging", lambda: derive_staging(spark, sf_dir))


def star_tables(spark: SparkSession, sf_dir: str) -> Star:
    return _once(
        spark, sf_dir, "star", lambda: write_and_read_star(spark, staging_tables(spark, sf_dir))
    )


def _analysis(name: str) -> Query:
    return lambda spark, sf_dir: ANALYSES[name].run(star_tables(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_tables(spark, sf_dir).game_log


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables(spark, sf_dir).fact_team_game


def _landed(spark: SparkSession, sf_dir: str, table: str, read: Callable) -> DataFrame:
    """Land a derived staging table as JSON Lines and read it back with the landing reader."""

    def prepare() -> str:
        path = scratch_path(spark, f"landed_{table}")
        getattr(staging_tables(spark, sf_dir), table).write.json(path)
        return path

    return read(spark, _once(spark, sf_dir, f"landed_{table}", prepare), lines=True)


def stg_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams landed as indented arrays, a file for each block of 30 teams, and read back."""

    def prepare() -> str:
        folder = scratch_path(spark, "landed_team_arrays")
        teams = staging_tables(spark, sf_dir).teams
        name = F.format_string("teams_%06d.json", F.expr("id div 30")).alias("file_name")
        blocks = teams.groupBy(name).agg(F.collect_list(F.struct(*teams.columns)).alias("teams"))
        arrays = blocks.select("file_name", F.to_json("teams", {"pretty": "true"}).alias("value"))
        _named_files(arrays, folder, "text")
        return folder

    return landed.read_teams(spark, _once(spark, sf_dir, "landed_team_arrays", prepare))


def _named_files(df: DataFrame, folder: str, kind: str = "json") -> None:
    """Write each group of ``file_name`` as the file of that name in ``folder``."""
    spark = df.sparkSession
    parts = scratch_path(spark, "named")
    df.repartition("file_name").write.partitionBy("file_name").format(kind).save(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for found in system.globStatus(hadoop.Path(f"{parts}/file_name=*/part-*")):
        name = found.getPath().getParent().getName().removeprefix("file_name=")
        system.rename(found.getPath(), hadoop.Path(f"{folder}/{name}"))


def stg_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stats tables, landed as a file per season, place and kind, read back by their names."""

    def prepare() -> str:
        staging = staging_tables(spark, sf_dir)
        folder = scratch_path(spark, "landed_stats")

        def named(df: DataFrame, kind: str) -> DataFrame:
            name = F.concat("season", F.lit("_"), "location", F.lit(f"_{kind}_team_stats.json"))
            return df.withColumn("file_name", name).drop("season", "location")

        base = named(staging.team_stats_base, "Base")
        advanced = named(staging.team_stats_advanced, "Advanced")
        # A file of neither kind belongs to no table.
        other = base.withColumn("file_name", F.lit("2001-02_Home_Other_team_stats.json"))
        files = base.unionByName(advanced, allowMissingColumns=True)
        _named_files(files.unionByName(other, allowMissingColumns=True), folder)
        return folder

    folder = _once(spark, sf_dir, "landed_stats", prepare)
    base = landed.read_team_stats_base(spark, folder, lines=True)
    advanced = landed.read_team_stats_advanced(spark, folder, lines=True)
    return base.unionByName(advanced, allowMissingColumns=True)


def opponent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _game_log(spark, sf_dir).select("game_id", "team_id", "pts")
    return with_opponent(log, "game_id", "team_id", "opponent_team_id", {"pts": "opp_pts"}).drop("pts")


def rest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _game_log(spark, sf_dir).select(
        "game_id", "team_id", "season_id", F.to_date("game_date").alias("game_date")
    )
    rested = days_since_previous(log, ["team_id", "season_id"], "game_date", "rest_days", ["game_id"])
    return rested.select(
        "game_id",
        "team_id",
        "rest_days",
        F.coalesce(F.col("rest_days") == 1, F.lit(False)).alias("is_back_to_back"),
    )


def season_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_season_id")
    return (
        _game_log(spark, sf_dir)
        .groupBy(F.col("season_id").alias("raw_season_id"))
        .agg(F.count(F.lit(1)).alias("team_games"))
        .select("raw_season_id", season_label(raw).alias("season_id"), "team_games")
    )


def cond_avg_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).groupBy("season_id").agg(
        cond_avg(F.col("pts"), F.col("wl") == "W").alias("pts_in_wins"),
        cond_avg(F.col("pts"), F.col("rest_days") == 1).alias("pts_tired"),
    )


def gap_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = F.col("is_home")
    return _facts(spark, sf_dir).groupBy("team_id").agg(
        gap(F.col("pts"), home, ~home).alias("pts_gap")
    )


def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = star_tables(spark, sf_dir)
    points = star.fact_team_game.groupBy("season_id").agg(F.avg("pts").alias("avg_pts"))
    return points.join(star.dim_season, "season_id").select(
        "season_start_year",
        "avg_pts",
        change_from_previous(F.col("avg_pts"), "season_start_year").alias("yoy_change"),
    )


def tier(spark: SparkSession, sf_dir: str, **sizing) -> DataFrame:
    star = star_tables(spark, sf_dir)
    strength = star.fact_team_game.groupBy("team_id", "season_id").agg(
        win_rate(F.col("wl")).alias("season_w_pct")
    )
    return with_tier(strength, 3, ["season_id"], "season_w_pct", "team_id", "tier", **sizing)


def rank(spark: SparkSession, sf_dir: str, **sizing) -> DataFrame:
    star = star_tables(spark, sf_dir)
    wins = star.fact_team_game.groupBy("team_id").agg(
        F.sum(won(F.col("wl"))).cast("long").alias("wins")
    )
    return with_ranks(wins, {"win_rank": "wins"}, **sizing)


def rolling_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _game_log(spark, sf_dir).select("game_id", "team_id", "season_id", "game_date", "pts")
    rolled = rolling_mean(
        log, ["team_id", "season_id"], ["game_date", "game_id"], "pts", 10, "rolling_pts"
    )
    return rolled.select("game_id", "team_id", "rolling_pts")


def cond_avg_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    discounted = cond_avg(F.col("l_quantity"), F.col("l_discount") > 0.05)
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(discounted.alias("discounted_quantity"))
    )


def days_since_previous_events(spark: SparkSession, sf_dir: str, **sizing) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.to_date("ts").alias("day")
    )
    return days_since_previous(events, ["user_id"], "day", "days_since", ["ts", "event_id"], **sizing).select(
        "event_id", "user_id", "days_since"
    )


def rolling_mean_events(spark: SparkSession, sf_dir: str, **sizing) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    rolled = rolling_mean(events, ["user_id"], ["ts", "event_id"], "value", 10, "rolling", **sizing)
    return rolled.select(
        "event_id", "user_id", round_half_away(F.col("rolling"), 4).alias("rolling_value")
    )


def _few_chunks(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Most groups of events count as hot, and are cut into a few dozen chunks together."""
    return {"rows_per_task": 40, "chunk_rows": 1 + _table(spark, sf_dir, "events").count() // 16}


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (staging_tables(spark, sf_dir), star_tables(spark, sf_dir))
    return row_counts({f.name: getattr(group, f.name) for group in tables for f in fields(group)})


def _faulty(star: Star) -> Star:
    """The star with faults of every kind added, so that each rule has something to find."""
    team, season, game, facts, stats = (getattr(star, field.name) for field in fields(Star))
    day = F.col("day_of_week")
    reform = F.col("era") == "Schedule Reform"
    return Star(
        dim_team=team.filter("abbreviation <> 'DEN'").union(team.filter("conference = 'East'")),
        dim_season=season.filter("not is_lockout")
        .withColumn("era", F.when(~reform, F.col("era")))
        .union(season.filter("is_covid")),
        dim_game=game.filter(day != "Monday")
        .withColumn("game_date", F.when(day != "Tuesday", F.col("game_date")))
        .union(game.filter(day == "Sunday")),
        fact_team_game=facts.union(facts.filter("rest_days >= 4"))
        .union(facts.filter("pts >= 130").withColumn("team_id", -F.col("team_id"))),
        fact_team_season=stats.union(stats.filter("location = 'Home' AND w > l")),
    )


def dq_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the star schema with its number of violations, on a star with added faults."""
    found = star_violations(_faulty(star_tables(spark, sf_dir)))
    return reduce(DataFrame.unionByName, found).drop("example")


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "q4_back_to_back"
    analysis = ANALYSES[name]
    result = analysis.run(star_tables(spark, sf_dir))
    written = export(result, scratch_path(spark, "export"), analysis.theme, name)
    return read_result(spark, written)


def export_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all ten analyses; each with the rows that its write counted."""
    folder = scratch_path(spark, "exports")
    export_all(star_tables(spark, sf_dir), folder)
    rows = [(name, ANALYSES[name].theme, result.rows) for name, result in read_catalog(spark, folder).items()]
    return spark.createDataFrame(rows, "name string, theme string, rows long")


def export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exported analysis as its files hold it: its rows, and those that are out of order."""

    def prepare() -> str:
        folder = scratch_path(spark, "ordered_exports")
        export_all(star_tables(spark, sf_dir), folder)
        return folder

    catalog = read_catalog(spark, _once(spark, sf_dir, "ordered_exports", prepare))
    found = []
    for name, result in catalog.items():
        rows = read_result(spark, result)
        broken = order_violations(spark, result.uri, ANALYSES[name].order)
        for counted, is_row in ((rows, 1), (broken, 0)):
            counts = counted.agg(F.count(F.lit(1)).alias("n"))
            found.append(counts.select(F.lit(name).alias("name"), "n", F.lit(is_row).alias("is_row")))
    by_kind = reduce(DataFrame.unionByName, found).groupBy("name")
    total = lambda is_row: F.sum(F.when(F.col("is_row") == is_row, F.col("n")))
    return by_kind.agg(total(1).alias("rows"), total(0).alias("out_of_order"))


def staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging tables, one of them empty, written and read back: rows written, rows read, and emptiness."""
    staging = staging_tables(spark, sf_dir)
    empty = replace(staging, team_stats_advanced=staging.team_stats_advanced.filter("team_id IS NULL"))

    def prepare() -> tuple[str, dict[str, int]]:
        folder = scratch_path(spark, "staging")
        return folder, write_staging(empty, folder)

    folder, written = _once(spark, sf_dir, "staging_roundtrip", prepare)
    again = read_staging(spark, folder)
    counts = row_counts({f.name: getattr(again, f.name) for f in fields(again)})
    rows = spark.createDataFrame(list(written.items()), "table_name string, written long")
    return counts.join(F.broadcast(rows), "table_name").withColumn("is_empty", F.col("written") == 0)


def entry(spark: SparkSession) -> DataFrame:
    return ANALYSES["q9_opponent_strength"].run(star_tables(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    return {
        "stg_teams": stg_teams,
        "stg_game_log": lambda s, d: _landed(s, d, "game_log", landed.read_game_log),
        "stg_team_stats": stg_team_stats,
        "dim_team": lambda s, d: star_plans.dim_team(staging_tables(s, d).teams),
        "dim_season": lambda s, d: star_plans.dim_season(_game_log(s, d)),
        "dim_game": lambda s, d: star_plans.dim_game(_game_log(s, d)),
        "fact_team_game": lambda s, d: star_plans.fact_team_game(_game_log(s, d)),
        "fact_team_season": lambda s, d: star_plans.fact_team_season(
            staging_tables(s, d).team_stats_base, staging_tables(s, d).team_stats_advanced
        ),
        "season_label": season_labels,
        "opponent_join": opponent_join,
        "rest_days": rest_days,
        "cond_avg": cond_avg_games,
        "gap": gap_games,
        "yoy_change": yoy_change,
        "tier": tier,
        "rank": rank,
        "rolling_mean": rolling_points,
        "cond_avg_lineitem": cond_avg_lineitem,
        "days_since_previous_events": days_since_previous_events,
        "rolling_mean_events": rolling_mean_events,
        # The same with groups of more than a few rows cut into chunks, as hot groups are.
        "days_since_previous_events_hot": lambda s, d: days_since_previous_events(s, d, **_few_chunks(s, d)),
        "rolling_mean_events_hot": lambda s, d: rolling_mean_events(s, d, **_few_chunks(s, d)),
        "tier_spread": lambda s, d: tier(s, d, rows_per_task=8),
        "rank_spread": lambda s, d: rank(s, d, rows_per_task=8),
        **{name: _analysis(name) for name in ANALYSES},
        "dq_primary_key": lambda s, d: primary_key_violations(
            _table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "dq_foreign_key": lambda s, d: foreign_key_violations(
            _table(s, d, "documents"), "doc_id", _table(s, d, "labels"), "doc_id"
        ),
        "dq_not_null": lambda s, d: not_null_violations(
            _game_log(s, d), ["wl", "fg3_pct", "pts"]
        ),
        "dq_star": dq_star,
        "row_counts": count_rows,
        "export_roundtrip": export_roundtrip,
        "export_catalog": export_catalog,
        "export_order": export_order,
        "staging_roundtrip": staging_roundtrip,
        **_text_queries(),
    }


def _text_queries() -> dict[str, Query]:
    if text_queries is None:
        return {}
    return {**text_queries.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return expected() if text_sql is None else {**expected(), **text_sql.oracle_sql()}
