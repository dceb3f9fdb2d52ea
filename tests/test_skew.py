from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave.operators.skew import key_splits, skew_join


def sides(spark):
    """One key holds a third of the left rows, another most of the right rows; some are null."""
    left = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")))
        .alias("key"),
        F.col("id").alias("l"),
    )
    right = spark.range(90, numPartitions=3).select(
        F.when(F.col("id") < 60, "k7")
        .when(F.col("id") == 60, "hot")
        .when(F.col("id") == 61, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
        F.col("id").alias("r"),
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("partitions", ["2", "7"])
def test_split_join_equals_the_plain_join(spark, how, partitions):
    left, right = sides(spark)
    expected = rows(left.join(right, "key", how))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        for limits in ({"cell_pairs": 50, "cell_rows": 40}, {"cell_pairs": 7, "cell_rows": 10**6}, {}):
            split = skew_join(left, right, "key", how, **limits)
            assert split.columns == ["key", "l", "r"] and rows(split) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_splits_follow_rows_and_pairs(spark):
    left, right = sides(spark)
    found = key_splits(left, right, "key", cell_pairs=300, cell_rows=400)
    # 1000 x 1 pairs; 13 x 60 pairs, though neither side of k7 is large
    assert found["hot"] == (4, 1) and found["k7"][0] * found["k7"][1] >= 2
    assert set(found) == {"hot", "k7"}
    assert key_splits(left, right, "key") == {}
    assert key_splits(left.limit(0), right, "key") == {}
    assert set(key_splits(left, right, "key", 300, 400, most=1)) == {"hot"}


def test_a_key_of_many_pairs_is_dealt_though_few_rows_have_it(spark):
    """40 x 50 rows of 20,000 a side: far below any share of rows, and all of the pairs."""
    def side(n, name):
        own = F.when(F.col("id") < n, F.lit("k")).otherwise(F.concat(F.lit(name), F.col("id").cast("string")))
        return spark.range(20_000).select(own.alias("key"), F.col("id").alias(name))

    left, right = side(40, "l"), side(50, "r")
    assert key_splits(left, right, "key", cell_pairs=500)["k"] == (2, 2)
    joined = skew_join(left, right, "key", cell_pairs=500)
    assert rows(joined) == rows(left.join(right, "key")) and joined.count() == 2_000


def test_a_hot_key_is_dealt_over_several_tasks(spark):
    left, right = sides(spark)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    thresholds = "spark.sql.autoBroadcastJoinThreshold"
    size = spark.conf.get(thresholds)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set(thresholds, "-1")
        joined = skew_join(left, right, "key", "left", cell_pairs=50, cell_rows=150)
        tasks = Counter(
            r.task
            for r in joined.where("key = 'hot'")
            .select(F.spark_partition_id().alias("task"))
            .collect()
        )
        assert len(tasks) > 1 and sum(tasks.values()) == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set(thresholds, size)


def test_other_joins_are_refused(spark):
    left, right = sides(spark)
    with pytest.raises(ValueError, match="inner"):
        skew_join(left, right, "key", "full")


def test_both_sides_are_dealt_by_the_same_splits(spark):
    left, right = sides(spark)
    joined = skew_join(left, right, "key", cell_pairs=50, cell_rows=150)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    # the hot keys stand in the plan as values; nothing counts them again when it runs
    assert "Aggregate" not in plan
    none_hot = skew_join(left, right, "key")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in none_hot


def test_null_keys_go_round_the_join(spark):
    left, right = sides(spark)
    plan = skew_join(left, right, "key", "left")._jdf.queryExecution().optimizedPlan().toString()
    joined, around = plan.split("\n+- ")
    assert "Union" in plan and "Join LeftOuter" in joined and "isnotnull" in joined
    assert "Join" not in around and "null AS r" in around
    known = left.withColumn("key", F.coalesce("key", F.lit("none")))
    assert "Union" not in skew_join(known, right, "key", "left")._jdf.queryExecution().optimizedPlan().toString()
