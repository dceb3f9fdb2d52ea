import re
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave.specs import AuditSpec, FeedSpec

NOW = datetime(2025, 4, 5, 7, 8, 9)


def test_audit_tokens_are_replaced_in_order(spark):
    spec = AuditSpec((("A", "x {INPUT_FILE_NAME}"), ("B", "{CURRENT_USER}/{CURRENT_DATE}")))
    df = op.add_audit(spark.range(1), spec, "f-{CURRENT_DATE}", NOW, "me")
    assert rows(df) == [(0, "x f-2025-Apr-05 07:08:09", "me/2025-Apr-05 07:08:09")]
    assert df.columns == ["id", "A", "B"]


def test_audit_takes_a_file_name_column_and_the_query_clock(spark):
    df = spark.createDataFrame([("a.csv",), ("b.csv",)], "f string")
    out = op.add_audit(df, AuditSpec.default(), F.col("f"), None, "me")
    assert {r.SRC_INPUT_FILE_NAME for r in out.collect()} == {"a.csv", "b.csv"}
    assert re.fullmatch(r"\d{4}-[A-Z][a-z]{2}-\d\d \d\d:\d\d:\d\d", out.first().CREATED_DT)


def test_uuid_ids_are_unique_and_version_4(spark):
    ids = [r.BU_REC_ID for r in op.add_record_id(spark.range(500), "uuid").collect()]
    assert len(set(ids)) == 500
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", i) for i in ids)


def test_hash_ids_repeat_across_runs_and_tell_null_fields_apart(spark):
    df = spark.createDataFrame([("T", "1"), ("T", "2"), (None, "T|1")], "SRC_TP_CD string, SRC_ID string")
    first, second = (rows(op.add_record_id(df, "hash")) for _ in range(2))
    assert first == second and len({r[2] for r in first}) == 3
    with pytest.raises(ValueError, match="id mode"):
        op.add_record_id(df, "serial")


def test_hash_ids_of_different_keys_differ(spark):
    values = ["", None, "a", "a|b", "b", "|", "1:a", "-", "a1:b"]
    pairs = [(x, y) for x in values for y in values]
    df = spark.createDataFrame(pairs, "SRC_TP_CD string, SRC_ID string")
    assert len({r.BU_REC_ID for r in op.add_record_id(df, "hash").collect()}) == len(pairs)


def test_numbered_ids_are_unique_and_repeat_across_layouts(spark):
    feed = [("T", str(i % 40), f"n{i % 7}") for i in range(300)]
    feed += [("T", "hot", "copy")] * 500 + [("T", "hot", f"other {i}") for i in range(50)]
    feed += [(None, "1", "x"), (None, "1", "x"), ("", "1", None), ("T", "alone", "x")]
    columns = "SRC_TP_CD string, SRC_ID string, NAME string"
    df = spark.createDataFrame(feed, columns)
    found = op.add_record_id(df, "numbered").collect()
    assert len({r.BU_REC_ID for r in found}) == len(feed)
    assert sorted((tuple(r)[:3] for r in found), key=repr) == sorted(feed, key=repr)
    again = op.add_record_id(spark.createDataFrame(feed[::-1], columns).repartition(5), "numbered")
    assert rows(again) == sorted((tuple(r) for r in found), key=repr)
    plain = {r.BU_REC_ID for r in op.add_record_id(df, "hash").collect()}
    assert plain < {r.BU_REC_ID for r in found}  # the first row of each key keeps the plain id
    assert op.add_record_id(df.limit(0), "numbered").count() == 0


def test_unrepeated_keys_are_not_shuffled_for_their_numbers(spark):
    df = spark.createDataFrame([("T", "1")], "SRC_TP_CD string, SRC_ID string")
    plan = op.add_record_id(df, "numbered")._jdf.queryExecution().executedPlan().toString()
    passing = plan.split("LeftAnti")[1].split("LeftSemi")[0]
    assert "Exchange" not in passing.split("BroadcastExchange")[0]


def test_blank_fill_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None), ("a", 1)], "s string, n int")
    assert rows(op.fill_blank(df)) == [("", None), ("a", 1)]


@pytest.mark.parametrize(
    ("zip5", "zip4", "expected"),
    [
        ("07030", "0001", "07030-0001"),
        (None, "0001", "0001"),
        ("07030", None, "07030"),
        (None, None, ""),
        ("", "", "-"),
    ],
)
def test_zip9(spark, zip5, zip4, expected):
    df = spark.createDataFrame([(zip5, zip4)], "STD_ORG_ZIP_CODE string, STD_ORG_ZIP_SUPP string")
    assert op.add_zip9(df).first().STD_ORG_ZIP9 == expected


def test_projection_follows_the_layout(spark):
    spec = FeedSpec.accounts()
    wide = spark.range(1).select(*(F.lit(s).alias(s) for s, _ in reversed(spec.outputs)))
    out = op.project_output(wide, spec)
    assert out.columns == [t for _, t in spec.outputs]
    assert tuple(out.first()) == tuple(s for s, _ in spec.outputs)
