"""Ranks from range partitions against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from loanframe.operators import ranked


@pytest.fixture(autouse=True)
def several_ranges(spark):
    # Small ranges would be merged into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _plain(rows):
    out = {}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        out.update({(r[0], r[2]): i for i, r in enumerate(own, 1)})
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_within_groups_equal_a_sort(spark, seed):
    r = random.Random(seed)
    # One group holds most rows; a null group is a group.
    rows = [(r.choice(["hot"] * 8 + ["a", None]), r.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    out = ranked(df, [F.desc("v"), F.asc("id")], ["g"]).collect()
    assert {(x.g, x.id): x["rank"] for x in out} == _plain(rows)


def test_one_group_is_ranked_in_many_tasks(spark):
    df = spark.range(20_000).withColumn("v", F.hash("id"))
    out = ranked(df, [F.asc("v"), F.asc("id")], name="place")
    got = [x.id for x in out.orderBy("place").collect()]
    assert got == [x.id for x in df.orderBy("v", "id").collect()]
    assert out.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first()[:] == (1, 20_000, 20_000)
    # Reading the ranks sorts nothing and needs no window over the rows.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_empty_repeated_and_clashing(spark):
    empty = spark.createDataFrame([], "at string, span int, rank int")
    assert ranked(empty, [F.asc("span")], ["at"]).columns == ["at", "span", "rank"]
    assert ranked(empty, [F.asc("span")], ["at"]).count() == 0
    same = spark.createDataFrame([("x", 1, 9)] * 5, "at string, span int, rank int")
    out = ranked(same, [F.asc("span")], ["at"]).collect()
    assert sorted(x["rank"] for x in out) == [1, 2, 3, 4, 5]
