"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave import plans
from workload import tables as t

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Small test tables would all be broadcast; plan as for large ones."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def shuffles_of_records(df):
    return plan(df).count("Exchange hashpartitioning(BU_REC_ID")


def columns_read(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return max(s.count(":") for s in re.findall(r"ReadSchema: struct<(.*)>", plan(df)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_match_request_reads_only_its_columns(spark):
    requests = op.match_requests(op.fill_blank(op.add_zip9(t.stage(spark, SF_DIR))))
    # before any other look at the plan, which would fix its shortened form
    assert columns_read(spark, requests) == 13
    assert shuffles(requests) == 0


def test_row_wise_steps_do_not_shuffle(spark):
    prepared = t.prepared(spark, SF_DIR)
    for df in (prepared, op.cleanse_requests(prepared), op.match_features(t.stage(spark, SF_DIR))):
        assert "Exchange" not in plan(df)


def test_each_side_of_an_exchange_is_shuffled_once(spark):
    stage, answers = t.stage(spark, SF_DIR), t.match_responses(spark, SF_DIR)
    assert shuffles_of_records(plans.match_feed(stage, answers)) == 2
    cleansed = op.attach_cleansing(t.prepared(spark, SF_DIR), t.cleansing_responses(spark, SF_DIR))
    assert shuffles_of_records(cleansed) == 2


def test_standardize_and_match_in_one_plan_shuffle_the_records_once(spark):
    stage = plans.standardize_feed(
        t.prepared(spark, SF_DIR), t.SPEC, t.cleansing_responses(spark, SF_DIR)
    )
    matched = plans.match_feed(stage, t.match_responses(spark, SF_DIR))
    assert shuffles_of_records(matched) == 3  # the records, and each kind of answer
    assert shuffles(matched) == 5  # one filter of their ids serves both kinds


def test_no_python_and_no_nested_loops_in_the_jobs(spark):
    stage = plans.standardize_feed(
        t.prepared(spark, SF_DIR), t.SPEC, addresses=t.address_reference(spark, SF_DIR)
    )
    matched = plans.match_feed(stage, master=t.cluster_master(spark, SF_DIR))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan(matched)


def test_answers_are_sifted_before_they_are_reduced(spark):
    """A filter of bounded size, from the record ids, lies below the aggregate of the answers."""
    stage, prepared = t.stage(spark, SF_DIR), t.prepared(spark, SF_DIR)
    answers, cleansed = t.match_responses(spark, SF_DIR), t.cleansing_responses(spark, SF_DIR)
    requests = op.match_requests(op.fill_blank(op.add_zip9(stage)))
    for df in (
        op.attach_cleansing(prepared, cleansed),
        op.attach_matches(op.add_zip9(stage), answers, "lenient"),
        op.attach_matches(op.add_zip9(stage), answers, "strict"),
        op.rejects(answers, "match", requests=requests),
    ):
        text = plan(df)
        reduce, sift = text.index("functions=[max("), text.index("LeftSemi")
        assert reduce < sift  # printed from the top: the semi-join lies below
        assert "Exchange" not in text[sift : text.index("Scan parquet", sift)].split("BroadcastExchange")[0]


def test_only_the_partitions_of_the_feed_are_read(spark, folder):
    answers = t.match_responses(spark, SF_DIR).withColumn(
        "FEED", F.concat(F.lit("feed-"), F.substring("BU_REC_ID", 1, 1))
    )
    answers.write.partitionBy("FEED").parquet(f"{folder}/answers")
    stored, stage = spark.read.parquet(f"{folder}/answers"), op.add_zip9(t.stage(spark, SF_DIR))
    df = op.attach_matches(stage, stored, "strict", feeds=["feed-a"])
    assert re.search(r"PartitionFilters: \[[^]]*FEED[^]]*feed-a", plan(df))
    want = op.attach_matches(stage, answers.where("FEED = 'feed-a'"), "strict")
    assert sorted(df.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_a_composed_job_sifts_without_its_own_joins(spark):
    """The ids come from the records alone; the cleansing join is not run again for them."""
    stage = plans.standardize_feed(
        t.prepared(spark, SF_DIR), t.SPEC, responses=t.cleansing_responses(spark, SF_DIR)
    )
    assert plan(plans.match_feed(stage, t.match_responses(spark, SF_DIR))).count("from_xml(") == 3


def test_bodies_of_answers_are_made_where_they_are_written(spark):
    for derive in (t.match_responses, t.cleansing_responses):
        text = plan(derive.__wrapped__(spark, SF_DIR))
        assert text.index(" AS body") < text.index("Exchange RoundRobinPartitioning")
