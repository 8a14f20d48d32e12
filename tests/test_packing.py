"""Numbers packed for the shuffle come back as they were, and the fact build moves few bytes."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from hardwood.operators.opponents import with_opponent
from hardwood.operators.packing import HIGHEST, LOWEST, pack, unpacked
from hardwood.plans.star import fact_team_game
from tests.test_plans import plan_of
from tests.test_star import log_of, team_game

_DATE = "1999-11-01"


def test_packed_numbers_come_back(spark):
    edges = [0, LOWEST, HIGHEST, LOWEST - 1, HIGHEST + 1, 127, 128, -128, -129, 2**31 - 1, -(2**31), None]
    rows = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in edges for b in edges)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    packed = pack(df, ["a", "b"])
    back = packed.repartition(3).select("id", *[c.alias(n) for n, c in unpacked(["a", "b"]).items()])
    assert sorted(map(tuple, back.collect())) == rows
    assert back.schema["a"].dataType == df.schema["a"].dataType
    as_bytes = {row.id for row in packed.filter("_packed_ints IS NULL").collect()}
    fits = lambda x: x is None or LOWEST <= x <= HIGHEST
    assert as_bytes == {i for i, a, b in rows if fits(a) and fits(b)}


def test_facts_keep_numbers_of_any_size(spark):
    log = log_of(
        spark,
        team_game("g1", 1, 2, _DATE, 2**31 - 1, fga=None, plus_minus=-300.0),
        team_game("g1", 2, 1, _DATE, 70, home=False, wl="L", plus_minus=None),
    )
    facts = {row.team_id: row for row in fact_team_game(log).collect()}
    assert (facts[1].pts, facts[1].opp_pts, facts[1].fga, facts[1].plus_minus) == (2**31 - 1, 70, None, -300)
    assert (facts[2].pts, facts[2].opp_pts, facts[2].fga, facts[2].plus_minus) == (70, 2**31 - 1, 10, None)


def test_wide_rows_are_packed_and_events_neither_combined_nor_broadcast(spark):
    log = log_of(spark, team_game("g1", 1, 2, _DATE, 90), team_game("g1", 2, 1, _DATE, 80, home=False))
    plan = re.sub(r"#\d+", "", plan_of(fact_team_game(log)))
    assert "Broadcast" not in plan, "also where its estimated size is small"
    wide, narrow = sorted(
        (re.search(r"Exchange hashpartitioning\(game_id.*?\n(.*)", plan[at.start() :]).group(1)
         for at in re.finditer(r"Exchange hashpartitioning\(game_id", plan)),
        key=lambda below: "_packed_bytes" not in below,
    )
    assert "_packed_bytes" in wide
    assert "HashAggregate" not in narrow


def test_rows_of_no_event_have_no_opponent(spark):
    rows = [(None, 1, 5), (None, 2, 6), (None, 3, 7), ("e", 1, 8), ("e", 2, 9)]
    df = spark.createDataFrame(rows, "event string, side int, points int")
    found = with_opponent(df, "event", "side", "other", {"points": "other_points"})
    assert sorted(map(str, (tuple(row) for row in found.collect()))) == sorted(
        map(str, [(None, 1, 5, None, None), (None, 2, 6, None, None), (None, 3, 7, None, None),
                  ("e", 1, 8, 2, 9), ("e", 2, 9, 1, 8)])
    )
    assert found.filter(F.col("other").isNull()).count() == 3
