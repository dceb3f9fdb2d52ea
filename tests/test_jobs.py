from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave import layouts, plans, sources, streaming
from acctweave import operators as op
from acctweave.specs import FeedSpec
from workload import tables as t

NOW = datetime(2025, 4, 15)
FEED = [
    ["1", "CRM", "Acme, Inc", "1 Main Street", "", "", "Hoboken", "NJ", "07030", "", "US", "2015550101", "", ""],
    ["2", "CRM", "Bolt", "2 Main Street", "", "", "Hoboken", "NJ", "07030", "0002", "US", "", "", ""],
]


def feed_text(feed, spec, header=True):
    lines = [",".join(spec.schema.names)] if header else []
    return "\n".join(lines + [",".join(f'"{v}"' if "," in v else v for v in r) for r in feed]) + "\n"


def land(folder, name, feed, spec):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(feed_text(feed, spec) + "\n")


def answers(spark, prepared):
    one = '{"clusterId": "C1", "avgMatchProb": 0.9}'
    ids = prepared.where("SRC_ID = '1'").select("BU_REC_ID")
    return ids.select("BU_REC_ID", F.lit(200).alias("status"), F.lit(one).alias("body"))


def test_feed_to_published_files_and_table(spark, folder):
    spec = FeedSpec.accounts("feed.csv.k")
    land(f"{folder}/in", "feed.csv.k", FEED, spec)
    feed = sources.scan_feed(spark, f"{folder}/in/feed.csv.k", spec, header=True)
    prepared = plans.prepare_feed(feed, "feed.csv.k", NOW, "me")
    none = spark.createDataFrame([], "BU_REC_ID string, status int, body string")
    stage = plans.standardize_feed(prepared, spec, responses=none)
    assert stage.columns == [c for _, c in spec.outputs]
    op.write_out(stage, f"{folder}/stage", "PARQUET")
    stage = sources.scan_stage(spark, f"{folder}/stage", spec.stage_schema)
    matched = plans.match_feed(stage, responses=answers(spark, prepared))
    assert len(matched.columns) == 51
    name = f"matched_{abs(hash(folder))}"
    written = plans.publish(matched, f"{folder}/out", name, path=f"{folder}/table")
    expected = [("1", "Acme, Inc", "C1", 0.9), ("2", "Bolt", None, None)]
    for df in (
        written,
        spark.table(name),
        sources.scan_stage(spark, f"{folder}/out", matched.schema, "CSV"),
    ):
        assert rows(df.select("SRC_ID", "SRC_ORG_NAME", "ORG_ID", "ORG_MATCH_CONFIDENCE")) == expected


def test_random_ids_are_drawn_once_when_published(spark, folder):
    spec = FeedSpec.accounts("f")
    feed = spark.createDataFrame(FEED, spec.schema)
    prepared = plans.prepare_feed(feed, "f", NOW, "me", id_mode="uuid")
    name = f"ids_{abs(hash(folder))}"
    plans.publish(prepared, f"{folder}/out", name, path=f"{folder}/table")
    filed = sources.scan_stage(spark, f"{folder}/out", prepared.schema, "CSV")
    assert rows(filed.select("BU_REC_ID")) == rows(spark.table(name).select("BU_REC_ID"))


def test_sources_of_answers_are_exclusive(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="either"):
        plans.standardize_feed(df, FeedSpec.accounts())
    with pytest.raises(ValueError, match="either"):
        plans.match_feed(df, df, df)


def test_cap_takes_records_before_they_fan_out(spark):
    stage = t.stage(spark, "/root/testdata/sf0.001")
    matches = t.match_responses(spark, "/root/testdata/sf0.001")
    capped = plans.match_feed(stage, matches, policy="strict", cap=50)
    ids = {r.SRC_ID for r in op.cap_rows(stage, 50).select("SRC_ID").collect()}
    whole = rows(plans.match_feed(stage, matches, policy="strict"))
    assert set(rows(capped)) <= set(whole) and {r.SRC_ID for r in capped.collect()} <= ids


def test_landing_reads_each_file_once(spark, folder):
    spec = FeedSpec.accounts()
    args = (spark, f"{folder}/in", spec, f"{folder}/out", f"{folder}/offsets")
    land(f"{folder}/in", "feed.csv.k1", FEED[:1], spec)
    land(f"{folder}/in", "feed.csv.k2", FEED[1:], spec)
    for _ in range(2):
        streaming.ingest_landing(*args, header=True)
    expected = [("1", "Acme, Inc", "feed.csv.k1"), ("2", "Bolt", "feed.csv.k2")]
    out = spark.read.parquet(f"{folder}/out")
    assert rows(out.select("SRC_ID", "ORG_NAME", streaming.landing.LANDED_FILE)) == expected


def test_stream_equals_batch_and_a_repeated_batch_changes_nothing(spark, folder):
    spec, name = FeedSpec.accounts(), f"streamed_{abs(hash(folder))}"
    feed = spark.createDataFrame(FEED, spec.schema)
    prepared = plans.prepare_feed(feed, "x", NOW, "me")
    none = spark.createDataFrame([], "BU_REC_ID string, status int, body string")
    matches = answers(spark, prepared)

    def run(offsets):
        streaming.stream_feed(
            spark, f"{folder}/in", spec, name, offsets, user="me", now=NOW, header=True,
            cleansing=none, matches=matches, table_path=f"{folder}/table",
        )

    for n, part in enumerate((FEED[:1], FEED[1:])):
        land(f"{folder}/in", f"feed.csv.k{n}", part, spec)
        run(f"{folder}/offsets")
    batch = plans.match_feed(plans.standardize_feed(prepared, spec, none), matches)
    columns = [c for c in batch.columns if c != "SRC_INPUT_FILE_NAME"]
    assert rows(spark.table(name).select(columns)) == rows(batch.select(columns))
    assert rows(spark.table(name).select("SRC_ID", "SRC_INPUT_FILE_NAME", "batch_id")) == [
        ("1", "feed.csv.k0", 0),
        ("2", "feed.csv.k1", 1),
    ]
    # a lost checkpoint: batch 0 now holds both files and replaces its old partition
    run(f"{folder}/offsets-new")
    assert spark.table(name).where("batch_id = 0").count() == 2


def test_native_stream_equals_batch(spark, folder):
    spec, name = FeedSpec.accounts(), f"native_{abs(hash(folder))}"
    addresses = spark.createDataFrame(
        [tuple({"ADDR1": "1 MAIN ST", "ZIP": "07030", "CITY": "HOBOKEN"}.get(f) for f in layouts.ADDRESS_FIELDS)],
        ", ".join(f"{f} string" for f in layouts.ADDRESS_FIELDS),
    )
    master = spark.createDataFrame(
        [("C1", "m1", "ACME, INC", "1 MAIN ST", "07030", "201", "2015550101")],
        "ORG_ID string, MEMBER_ID string, name string, line1 string, zip5 string, "
        "areacode string, phone string",
    )
    land(f"{folder}/in", "feed.csv.k1", FEED, spec)
    streaming.stream_feed(
        spark, f"{folder}/in", spec, name, f"{folder}/offsets", user="me", now=NOW, header=True,
        addresses=addresses, master=master, table_path=f"{folder}/table",
    )
    got = spark.table(name).select("SRC_ID", "STD_ORG_CITY", "ORG_ID", "ORG_MATCH_CONFIDENCE")
    assert rows(got) == [("1", "HOBOKEN", "C1", 1.0), ("2", "", None, None)]
    prepared = plans.prepare_feed(spark.createDataFrame(FEED, spec.schema), "x", NOW, "me")
    stage = op.hand_off(plans.standardize_feed(prepared, spec, addresses=addresses))
    strict = plans.match_feed(stage, master=master, policy="strict")
    assert rows(strict.select("SRC_ID", "ORG_ID")) == [("1", "C1")]


def test_contact_feed(spark):
    spec = FeedSpec.from_dict(
        {
            "file_config": {"process_type": "CONTACT"},
            "input_fields": [{"name": n, "type": "STRING"} for n in layouts.CONTACT_INPUT],
            "output_fields": [
                {"source_field": n, "target_field": n}
                for n in ("BU_REC_ID", "PER_EMAIL", "STD_PER_LAST_NAME", "STD_PER_CITY_FAULT_CD")
            ],
        }
    )
    feed = spark.createDataFrame([tuple(n.lower() for n in layouts.CONTACT_INPUT)], spec.schema)
    prepared = plans.prepare_feed(feed, "c", NOW, "me", id_keys=["PER_EMAIL"])
    body = (
        '<e xmlns:a="urn:a"><a:Profile><a:LastNm>LEE</a:LastNm><Address><AddrCity FaultCode="S1"/>'
        "</Address></a:Profile></e>"
    )
    got = prepared.select("BU_REC_ID", F.lit(200).alias("status"), F.lit(body).alias("body"))
    out = plans.standardize_feed(prepared, spec, responses=got)
    assert rows(out.drop("BU_REC_ID")) == [("per_email", "LEE", "S1")]
