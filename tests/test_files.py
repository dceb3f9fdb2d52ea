import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave import scratch, sources
from acctweave.specs import FeedSpec


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def small_spec(**conf):
    return FeedSpec.from_dict(
        {
            "file_config": {"process_type": "ACCOUNTS", "attributes": conf, "delimiter": "|"},
            "input_fields": [
                {"position": 1, "name": "ID", "type": "STRING"},
                {"position": 3, "name": "ZIP", "type": "STRING"},
            ],
            "output_fields": [],
        }
    )


# ---- scans ----


def test_inference_is_a_switch(spark, folder):
    path = write(f"{folder}/a.csv", "ID,ZIP\n1,07030\n2,\n")
    assert rows(sources.scan_delimited(spark, path)) == [(1, 7030), (2, None)]
    assert rows(sources.scan_delimited(spark, path, infer=False)) == [("1", "07030"), ("2", None)]


def test_feed_scan_honours_the_spec(spark, folder):
    path = write(f"{folder}/a.csv", 'é|07030\n"a|b"|\n\n', encoding="iso-8859-1")
    spec = small_spec(has_header=False, encoding="ISO-8859-1")
    assert rows(sources.scan_feed(spark, path, spec)) == [("a|b", None), ("é", "07030")]


def test_feed_scan_checks_the_header(spark, folder):
    spec = small_spec(has_header=False)
    good = write(f"{folder}/good.csv", "ID|ZIP\n1|07030\n")
    assert rows(sources.scan_feed(spark, good, spec, header=True)) == [("1", "07030")]
    wrong = write(f"{folder}/wrong.csv", "ZIP|ID\n07030|1\n")
    with pytest.raises(Exception, match="header does not conform"):
        sources.scan_feed(spark, wrong, spec, header=True).collect()


def test_text_stage_needs_a_schema(spark, folder):
    with pytest.raises(ValueError, match="schema"):
        sources.scan_stage(spark, folder, file_type="CSV")


# ---- sinks ----

ROWS = [("1", "a,b", None), ("2", 'q"t', "x\ty"), ("3", "", "é")]


@pytest.mark.parametrize("file_type", ["CSV", "TAB", "PARQUET", "JSON", "ORC"])
def test_round_trips_overwrite(spark, folder, file_type):
    df = spark.createDataFrame(ROWS, "a string, b string, c string")
    path = f"{folder}/out"
    for _ in range(2):
        op.write_out(df, path, file_type)
    back = sources.scan_stage(spark, path, df.schema, file_type)
    assert rows(op.fill_blank(back)) == rows(op.fill_blank(df))


def test_unknown_types_are_refused(spark, folder):
    with pytest.raises(ValueError, match="file type"):
        op.write_out(spark.range(1), f"{folder}/out", "XLS")
    with pytest.raises(ValueError, match="mode"):
        op.write_table(spark.range(1), "t", "upsert")


def test_avro_names_the_missing_package(spark, folder):
    try:
        op.write_out(spark.range(1), f"{folder}/out", "AVRO")
    except RuntimeError as e:
        assert "spark-avro" in str(e)
    else:
        assert spark.read.format("avro").load(f"{folder}/out").count() == 1


def test_table_modes(spark, folder):
    df, name = spark.range(3).withColumn("part", F.col("id") % 2), f"t_{os.path.basename(folder)}"
    name = name.replace("-", "_")
    for mode, expected in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        op.write_table(df, name, mode, path=f"{folder}/t")
        assert spark.table(name).count() == expected
    parts = f"{name}_p"
    for n in (1, 2):  # the second run replaces only the partitions it brings
        rows_now = df if n == 1 else df.where("part = 1").withColumn("id", F.col("id") + 10)
        op.write_table(
            rows_now, parts, "overwrite_partitions", path=f"{folder}/p", partition_by="part"
        )
    assert rows(spark.table(parts).select("id")) == [(0,), (11,), (2,)]


def test_a_first_write_that_is_repeated_doubles_nothing(spark, folder, monkeypatch):
    """The table exists, empty, before the first rows come; rows of a lost attempt are replaced."""
    df, name = spark.range(3).withColumn("part", F.lit(1)), f"f_{os.path.basename(folder)}"
    name, key = name.replace("-", "_"), "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    for _ in range(2):
        op.write_table(df, name, "overwrite_partitions", path=f"{folder}/p", partition_by="part")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (part = 2)")
        assert spark.table(name).count() == 3 and spark.conf.get(key) == before
    op.write_table(df.limit(0), name, "overwrite_partitions", path=f"{folder}/p", partition_by="part")
    assert spark.table(name).count() == 3


def test_bucketed_table_joins_without_moving_its_rows(spark, folder):
    df = spark.range(100).select(F.col("id").cast("string").alias("BU_REC_ID"))
    name = f"b_{os.path.basename(folder)}".replace("-", "_")
    op.write_table(df, name, path=f"{folder}/b", buckets=(4, "BU_REC_ID"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table(name).join(df.groupBy("BU_REC_ID").count(), "BU_REC_ID")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the other side only
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


# ---- order and layout ----


def test_global_order_with_tie_breakers(spark):
    ids = [("2", "b", None), ("10", "a", "x"), ("2", "a", "y"), ("2", "a", "x")]
    df = spark.createDataFrame(ids, "SRC_ID string, BU_REC_ID string, ORG_ID string")
    got = [tuple(r) for r in op.sort_output(df).collect()]
    assert got == [("10", "a", "x"), ("2", "a", "x"), ("2", "a", "y"), ("2", "b", None)]
    assert [tuple(r) for r in op.cap_rows(df, 2).collect()] == got[:2]
    assert op.preview(df, 3).count() == 3
    plan = op.cap_rows(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_small_output_is_one_ordered_file(spark, folder):
    df = spark.range(1000, numPartitions=8).selectExpr("lpad(string(id), 4, '0') AS SRC_ID")
    op.write_out(op.ordered_files(df), f"{folder}/out", "CSV")
    files = glob.glob(f"{folder}/out/part-*")
    assert len(files) == 1
    with open(files[0]) as f:
        assert f.read().split() == ["SRC_ID"] + [f"{i:04}" for i in range(1000)]


def test_large_output_is_several_files_in_order(spark, folder):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    parallel = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = {k: spark.conf.get(k) for k in (size, smallest, parallel)}
    try:
        for k, v in ((size, "4k"), (smallest, "1k"), (parallel, "false")):
            spark.conf.set(k, v)
        df = spark.range(5000, numPartitions=8).selectExpr("lpad(string(id), 4, '0') AS SRC_ID")
        op.write_out(op.ordered_files(df), f"{folder}/out", "CSV")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = []
    files = sorted(glob.glob(f"{folder}/out/part-*"))
    for path in files:
        with open(path) as f:
            lines += f.read().split()[1:]
    assert len(files) > 1 and lines == [f"{i:04}" for i in range(5000)]


def test_spread_keeps_rows(spark):
    df = spark.range(100).withColumn("k", F.lit(1))
    assert op.spread(df, 10).rdd.getNumPartitions() == 10
    assert rows(op.spread(df, 10, "id")) == rows(df)


# ---- hook ----


def test_hook_returns_any_number_of_rows(spark):
    def repeat(batches):
        for batch in batches:
            yield batch.loc[batch.index.repeat(batch["id"] % 3)]

    out = op.enrich_partitions(spark.range(6, numPartitions=2), repeat, "id bigint")
    assert rows(out) == [(1,), (2,), (2,), (4,), (5,), (5,)]
    assert rows(op.enrich_partitions(spark.range(0), repeat, "id bigint")) == []


# ---- shared folder ----


class Session:
    """Stands for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_shared_folder_follows_the_session(folder):
    session = Session(spark_checkpoint_dir=folder, spark_master="yarn")
    first, second = scratch.shared_dir(session, "x"), scratch.shared_dir(session, "x")
    assert first.startswith(f"{folder}/") and first != second
    assert scratch.shared_dir(Session(spark_master="local[2]"))
    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_dir(Session(spark_master="yarn"))
