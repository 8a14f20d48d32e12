"""Windows over hot groups: the distributed way must give what one plain window gives."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hardwood.operators import windows
from hardwood.operators.metrics import with_ranks, with_tier
from hardwood.operators.sizes import hot_groups
from hardwood.operators.windows import days_since_previous, rolling_mean, row_positions

ROWS_PER_TASK = 60


def bag(df, *columns):
    return Counter(tuple(row) for row in df.select(*(columns or df.columns)).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """1,500 rows: a third in group 0 (of which half on one day), a hot NULL group, the rest small."""
    row = F.col("id")
    group = F.when(row % 3 == 0, 0).when(row % 3 == 1, (1 + row % 97).cast("int"))
    day = F.when((row % 3 == 0) & (row % 2 == 0), 7).otherwise((row * 7919 % 350).cast("int"))
    return spark.range(1500).select(
        row,
        group.alias("grp"),
        F.date_add(F.lit("2020-01-01"), day).alias("day"),
        (row * 31 % 11).cast("double").alias("value"),
    ).repartition(7)


def test_hot_groups_lists_only_large_groups(skewed):
    hot, rows = hot_groups(skewed, ["grp"], ROWS_PER_TASK)
    assert bag(hot) == Counter([(0,), (None,)])
    assert rows == 1000
    assert hot_groups(skewed, ["grp"], 600) is None


def test_rolling_mean_over_hot_groups(skewed):
    arguments = (skewed, ["grp"], ["day", "id"], "value", 10, "mean")
    plain = Window.partitionBy("grp").orderBy("day", "id").rowsBetween(-9, 0)
    expected = skewed.withColumn("mean", F.avg("value").over(plain))
    assert bag(rolling_mean(*arguments, rows_per_task=ROWS_PER_TASK)) == bag(expected)
    assert bag(rolling_mean(*arguments)) == bag(expected)


def test_rolling_mean_with_chunks_shorter_than_the_frame(skewed):
    arguments = (skewed, ["grp"], ["day", "id"], "value", 30, "mean")
    plain = Window.partitionBy("grp").orderBy("day", "id").rowsBetween(-29, 0)
    expected = skewed.withColumn("mean", F.avg("value").over(plain))
    assert bag(rolling_mean(*arguments, rows_per_task=20)) == bag(expected)


def test_days_since_previous_over_hot_groups(skewed):
    arguments = (skewed, ["grp"], "day", "days", ["id"])
    plain = Window.partitionBy("grp").orderBy("day", "id")
    expected = skewed.withColumn("days", F.datediff("day", F.lag("day").over(plain)))
    assert bag(days_since_previous(*arguments, rows_per_task=ROWS_PER_TASK)) == bag(expected)


def test_full_copies_are_cut_into_chunks(spark, monkeypatch):
    """Copies of one row are all equal in every column and still do not share one chunk."""
    copies = spark.range(900).select(
        F.lit(1).alias("grp"), F.lit("2020-01-01").cast("date").alias("day"), F.lit(2.0).alias("value")
    ).repartition(5)
    written = []
    keep = windows.keep
    monkeypatch.setattr(windows, "keep", lambda *a: written.append(keep(*a)) or written[-1])
    rolled = rolling_mean(copies, ["grp"], ["day"], "value", 10, "mean", rows_per_task=100)
    assert rolled.count() == 900
    assert bag(rolled, "mean") == Counter({(2.0,): 900})
    sizes = [row["count"] for row in written[0].groupBy("_chunk").count().collect()]
    assert len(sizes) > 9 and max(sizes) <= 200


def test_row_positions(skewed):
    order = [F.col("day").asc(), F.col("id").asc()]
    placed = row_positions(skewed, ["grp"], order, "position", rows_per_task=ROWS_PER_TASK)
    plain = F.row_number().over(Window.partitionBy("grp").orderBy("day", "id"))
    assert bag(placed) == bag(skewed.withColumn("position", plain))


def test_ranks_beyond_one_task(skewed):
    with_null = skewed.withColumn("value", F.when(F.col("id") % 50 != 0, F.col("value")))
    ranks = {"by_value": "value", "by_id": "id"}
    one_task = with_ranks(with_null, ranks)
    spread = with_ranks(with_null, ranks, rows_per_task=ROWS_PER_TASK)
    assert bag(spread, *one_task.columns) == bag(one_task)
    assert with_ranks(with_null.limit(0), ranks).count() == 0


def test_ranks_are_counted_not_claimed(skewed):
    """Beyond one task no window sees a row: only value counts are sorted, in many ranges."""
    plan = with_ranks(skewed, {"r": "value"}, rows_per_task=ROWS_PER_TASK)._jdf.queryExecution().toString()
    assert "rank(" not in plan
    few = with_ranks(skewed, {"r": "value"})._jdf.queryExecution().toString()
    assert "rank(" in few


@pytest.mark.parametrize("tiers", [3, 7, 40])
def test_tiers_beyond_one_task(skewed, tiers):
    arguments = (skewed, tiers, ["grp"], "value", "id", "tier")
    spread = with_tier(*arguments, rows_per_task=ROWS_PER_TASK)
    one_task = with_tier(*arguments)
    assert spread.schema["tier"].dataType == one_task.schema["tier"].dataType
    assert bag(spread, *one_task.columns) == bag(one_task)


def test_few_chunks_for_many_hot_groups(skewed, monkeypatch):
    written = []
    keep = windows.keep
    monkeypatch.setattr(windows, "keep", lambda *a: written.append(keep(*a)) or written[-1])
    arguments = (skewed, ["grp"], ["day", "id"], "value", 10, "mean")
    rolled = rolling_mean(*arguments, rows_per_task=3, chunk_rows=200)
    plain = Window.partitionBy("grp").orderBy("day", "id").rowsBetween(-9, 0)
    assert bag(rolled) == bag(skewed.withColumn("mean", F.avg("value").over(plain)))
    assert written[0].select("_chunk").distinct().count() < 20


def test_layout_by_prefix_sums_is_sorted_as_a_whole(skewed):
    sizes = skewed.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"))
    laid = windows.lay_out(skewed, ["grp"], sizes)
    assert bag(laid, *skewed.columns) == bag(skewed)
    assert laid.select(windows.PART).distinct().count() > 3
    ordered = laid.sortWithinPartitions(*windows.ascending(["grp", "id"])).collect()
    keys = [(r.grp is None, r.grp or 0, r.id) for r in ordered]
    assert keys == sorted(keys)
    # Too many groups for a broadcast, or one too large for a task.
    assert windows.lay_out(skewed, ["grp"], sizes, rows_per_task=400) is None
    assert windows.lay_out(skewed.limit(0), ["grp"], sizes.limit(0)) is None
    monkey = windows.BROADCAST_ROWS
    try:
        windows.BROADCAST_ROWS = 10
        assert windows.lay_out(skewed, ["grp"], sizes) is None
    finally:
        windows.BROADCAST_ROWS = monkey
