"""What the physical plans must keep to at scale."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from hearthline.functions import lexicon_score
from hearthline.operators import (
    TEXT_LENGTH,
    length_by_entity,
    match_profile,
    score_by_group,
    sql_over,
    top_by_matches,
    with_rank,
    without_match,
)
from hearthline.sinks import stage


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on tables too large to broadcast, with small limits for a hot key."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="30000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        yield


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, rows):
    """Half of all rows share the key 1; many input partitions."""
    key = F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("key")
    return spark.range(0, rows, 1, 16).select(
        key, F.sha2(F.col("id").cast("string"), 256).alias("name"), F.col("id").alias("n")
    )


def test_a_hot_entity_key_is_split_in_the_anti_join(spark, shuffled_joins):
    entities = hot(spark, 20_000)
    children = spark.range(2, 30_000).select((F.col("id") * 3).alias("ref"))
    result = without_match(entities, children, key="key", match_key="ref")
    plan = final_plan(result)
    assert "skew=true" in plan
    expected = entities.filter((F.col("key") % 3 != 0) | (F.col("key") < 6)).count()
    assert result.count() == expected


def exchanges(plan):
    """Shuffles in the final plan, without the initial plan below it."""
    return len(re.findall(r"Exchange hashpartitioning", plan.split("Initial Plan")[0]))


@pytest.mark.parametrize("staged", [False, True])
def test_a_hot_key_is_split_against_a_profile(spark, shuffled_joins, staged):
    entities = hot(spark, 20_000)
    children = spark.range(0, 60_000).select((F.col("id") % 20_000).alias("ref"), "id")
    profile = match_profile(children, "ref", id="id", score=F.lit(1))
    if staged:
        profile = stage(profile, "profile").table
    top = top_by_matches(entities, profile, 5, key="key")
    assert "skew=true" in final_plan(top)
    assert [r.num_reviews for r in top.collect()] == [3] * 5
    areas = entities.withColumn("area", F.substring("name", 1, 1))
    groups = score_by_group(areas, profile, key="key", group="area")
    plan = final_plan(groups)
    assert "skew=true" in plan and groups.agg(F.sum("review_count")).first()[0] == 60_000
    # Entities once, profile once, partial sums; for the unstaged profile its own, too.
    assert exchanges(plan) == (3 if staged else 4)
    lengths = length_by_entity(
        entities, match_profile(children, "ref", id="id", text="id"), 0, key="key"
    )
    assert "skew=true" in final_plan(lengths)
    left = without_match(entities, profile, key="key", match_key="ref", distinct=True)
    plan = final_plan(left)
    assert exchanges(plan) == (2 if staged else 3) and left.count() == 0


def test_a_hot_listing_is_split_in_sql(spark, shuffled_joins):
    listings = hot(spark, 20_000).withColumnRenamed("key", "id")
    reviews = spark.range(0, 60_000).select(
        (F.col("id") % 20_000).alias("listing_id"), "id", F.lit("xy").alias("comments")
    )
    result = sql_over(spark, TEXT_LENGTH, {"listings": listings, "reviews": reviews}, {"min_reviews": 1})
    assert "skew=true" in final_plan(result)
    assert result.agg(F.sum("reviews_count")).first()[0] == 60_000


def test_rows_of_a_hot_value_stay_spread_when_they_are_ranked(spark, shuffled_joins):
    rows = hot(spark, 20_000).withColumn("v", F.col("key").cast("double")).drop("key")
    for once in (True, False):
        ranked = with_rank(rows, "v", "r", once=once)
        assert ranked.agg(F.count("*"), F.max("r")).first() == (20_000, 10_000)
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) < 5_000  # half of the rows have one value


def without_initial_plans(plan):
    """The plan as it ran, with those of its subqueries."""
    kept, above = [], None
    for line in plan.splitlines():
        depth = re.search(r"[^\s:+|-]", line + "x").start()
        if above is not None and depth >= above:
            continue
        above = depth if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


def test_rank_reads_and_shuffles_its_input_once(spark, folder):
    hot(spark, 20_000).write.parquet(f"{folder}/t")
    totals = spark.read.parquet(f"{folder}/t").groupBy("key").agg(F.sum("n").alias("v"), F.max("name"))
    plan = without_initial_plans(final_plan(with_rank(totals, "v", "r")))
    assert "SortMergeJoin" not in plan and plan.count("ReusedExchange") >= 2
    assert "ReusedSubquery" in plan  # the ranges are drawn once
    assert len(re.findall("Scan parquet", plan)) == 1


def test_rank_runs_no_job_before_it_is_asked(spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    with_rank(spark.range(1000), "id", "r")
    assert len(tracker.getJobIdsForGroup()) == before


def test_children_are_reduced_before_the_shuffle(spark, shuffled_joins):
    children = hot(spark, 20_000)
    entities = spark.range(1, 50).select(F.col("id"), F.lit("e").alias("name"))
    top = top_by_matches(entities, match_profile(children, "key", id="n"), 3)
    assert [tuple(r) for r in top.collect()][0] == (1, "e", 10_001)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"Exchange hashpartitioning\(key.*\n.*HashAggregate.*partial_count", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_unused_measures_are_pruned(spark):
    children = spark.createDataFrame([(1, 2, "good")], "ref long, n long, comments string")
    entities = spark.createDataFrame([(1, "e")], "id long, name string")
    score = lexicon_score(F.col("comments"))
    profile = match_profile(children, "ref", id="n", text="comments", score=score)
    plan = top_by_matches(entities, profile, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "length(" not in plan


def test_score_needs_no_python_worker(spark):
    scored = spark.createDataFrame([("good",)], "t string").select(lexicon_score(F.col("t")))
    assert not re.search("Python|Pandas", final_plan(scored))
