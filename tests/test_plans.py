"""Physical plans: what is read, what is shuffled, and what must never appear."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hardwood.operators import metrics
from hardwood.operators.sizes import broadcast_if_small
from hardwood.plans.analyses import ANALYSES, side_totals
from oracle.queries_sql import expected

# The text queries read whole texts in Python tasks, by design.
QUERIES = {key: contract.queries()[key] for key in expected()}


_FACTS = "/fact_team_game]"


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole paths
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@contextmanager
def large_tables(spark):
    """Plan as if every table were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", QUERIES)
def test_no_pairs_and_no_python_in_plans(spark, sf_dir, key):
    with large_tables(spark):
        plan = plan_of(QUERIES[key](spark, sf_dir))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def test_broadcast_only_when_counted_small(spark):
    left, right = spark.range(50), spark.range(10)
    with large_tables(spark):
        small = plan_of(left.join(broadcast_if_small(right, rows=10), "id"))
        large = plan_of(left.join(broadcast_if_small(right, rows=9), "id"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" in large


def test_fact_build_shuffles_wide_rows_once(spark, sf_dir):
    with large_tables(spark):
        plan = plan_of(QUERIES["fact_team_game"](spark, sf_dir))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(exchanges) == ["game_id", "game_id", "team_id"]
    (window_input,) = re.findall(r"Exchange hashpartitioning\(team_id.*\n.*Project \[(.*)\]", plan)
    assert window_input.count(",") < 6


def test_rolling_query_sorts_its_result_without_a_second_shuffle(spark, sf_dir):
    with large_tables(spark):
        plan = plan_of(QUERIES["q6_rolling_home_win_pct"](spark, sf_dir))
    assert "rangepartitioning" not in plan, "nothing is sampled, so the join runs once"
    assert plan.count("SortMergeJoin") == 1
    exchanges = re.findall(r"(?<!Broadcast)Exchange (?!SinglePartition)(\w+)", plan)
    assert sorted(exchanges) == ["hashpartitioning"] * 2 + ["shufflepartitionidpassthrough"], "both sides of the join"


@pytest.mark.parametrize("name", ANALYSES)
def test_results_come_in_order(spark, sf_dir, name):
    """As collected, with NULLs last; the key ``export_order`` checks the files that are written."""
    result = QUERIES[name](spark, sf_dir)
    keys = [part for text in ANALYSES[name].order for part in (F.expr(text).isNull(), F.expr(text))]
    rows = [tuple(row) for row in result.select(*keys).collect()]
    assert len(rows) > 2
    plain = [tuple((row[i], "" if row[i] else row[i + 1]) for i in range(0, len(row), 2)) for row in rows]
    assert plain == sorted(plain)


def test_analyses_read_only_what_they_use(spark, sf_dir):
    plan = plan_of(QUERIES["q4_back_to_back"](spark, sf_dir))
    assert "ReadSchema: struct<is_home:boolean,wl:string,rest_days:int,is_back_to_back:boolean>" in plan
    assert "PushedFilters: [IsNotNull(rest_days)]" in plan
    plan = plan_of(QUERIES["q9_opponent_strength"](spark, sf_dir))
    assert "EqualTo(is_home,true), IsNotNull(opponent_team_id)" in plan


def _depth(line: str) -> int:
    return len(re.match(r"[ :+\-|]*", line).group())


@pytest.mark.parametrize("number", [1, 2, 5, 7, 8, 9, 10])
def test_facts_are_reduced_before_dimensions_join(spark, sf_dir, number, monkeypatch):
    # What ranks and tiers write and count is planned as one with the rest here.
    monkeypatch.setattr(metrics, "keep_counted", lambda df, label: (df, df.count()))
    (name,) = [name for name in QUERIES if name.startswith(f"q{number}_")]
    lines = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    scans = [at for at, line in enumerate(lines) if re.search(r"FileScan.*[\[,](wl|w_pct|fta|fg_pct)#", line)]
    assert scans
    for at in scans:
        above = [line for line in reversed(lines[:at]) if _depth(line) < _depth(lines[at])]
        first = next(line for line in above if "HashAggregate" in line or "Join" in line)
        assert "HashAggregate" in first


def test_checks_read_written_facts_twice_and_few_columns(spark, sf_dir):
    star = contract.star_tables(spark, sf_dir)
    with large_tables(spark):
        plans = [plan_of(found) for found in contract.star_violations(star)]
    scans = [scan for plan in plans for scan in re.findall(r"FileScan.*", plan)]
    facts = [scan for scan in scans if _FACTS in scan]
    assert [re.search(r"ReadSchema: struct<(.*)>", scan).group(1) for scan in facts] == [
        "game_id:string,team_id:int",
        "team_id:int,opponent_team_id:int,season_id:string",
    ]
    assert len(scans) == 9 and "Window" not in "".join(plans)
    games = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plans[2])
    assert [re.sub(r"#\d+", "", keys) for keys in games] == ["game_id", "game_id, team_id", "game_id"]


def test_bubble_query_reads_game_ids_of_bubble_seasons_only(spark, sf_dir):
    plan = plan_of(QUERIES["q3_covid_bubble"](spark, sf_dir))
    scans = [scan for scan in re.findall(r"FileScan.*", plan) if _FACTS in scan]
    met = [scan for scan in scans if "game_id:string" in scan]
    assert len(scans) == 2 and len(met) == 1 and re.search(r"season_id.*2019-20", met[0])


def test_catalog_reduces_the_facts_once(spark, sf_dir):
    star = contract.star_tables(spark, sf_dir)
    totals = contract.keep(side_totals(star), "totals")
    for name in ("q5_shooting_boost", "q7_referee_bias", "q8_conference_hca", "q10_turnover_comfort"):
        assert _FACTS not in plan_of(ANALYSES[name].run(star, totals))
    plan = plan_of(ANALYSES["q9_opponent_strength"].run(star, totals))
    assert plan.count(_FACTS) == 1
