"""Records that wait for answers: runs repeated at any point, patience, and tables without rows."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_jobs import FEED, answers, land

from acctweave import operators as op
from acctweave import plans, sources, streaming
from acctweave.operators.sieve import WORDS
from acctweave.specs import FeedSpec
from acctweave.streaming import late

NOW = datetime(2025, 4, 15)
SPEC = FeedSpec.accounts("feed.csv.k")
RESPONSE = "BU_REC_ID string, status int, body string"


@pytest.fixture
def job(spark, folder):
    """A call of the stream over one landed file, with some of the answers."""
    land(f"{folder}/in", "a.csv", FEED, SPEC)
    feed = sources.scan_feed(spark, f"{folder}/in/a.csv", SPEC, header=True)
    prepared = plans.prepare_feed(feed, "a.csv", NOW, "me")
    none = spark.createDataFrame([], RESPONSE)
    name = f"late_{abs(hash(folder))}"

    def call(matched=True, cleansed=True, **options):
        bodies = prepared.select("BU_REC_ID", F.lit(500).alias("status"), F.lit("").alias("body"))
        streaming.stream_late_feed(
            spark,
            f"{folder}/in",
            SPEC,
            name,
            f"{folder}/state",
            "me",
            NOW,
            header=True,
            cleansing=bodies if cleansed else none,
            matches=answers(spark, prepared) if matched else none,
            table_path=f"{folder}/table",
            **options,
        )
        return rows(spark.table(name).select("SRC_ID", "ORG_ID", "batch_id"))

    return call


def test_records_wait_for_both_answers(spark, folder, job):
    assert job(matched=False) == []
    assert job(cleansed=False) == []
    assert job() == [("1", "C1", 2)]
    assert streaming.open_records(spark, f"{folder}/state").count() == 1
    assert job() == [("1", "C1", 2)]
    assert job(close=True) == [("1", "C1", 2), ("2", None, 4)]
    log = streaming.run_log(spark, f"{folder}/state").orderBy("run").collect()
    assert [(r.source, r.n_open, r.n_settled) for r in log] == [
        (0, 2, 0), (None, 2, 0), (None, 1, 1), (None, 1, 0), (None, 0, 1),
    ]


def test_patience_runs_out(job):
    assert job(patience=1) == [("1", "C1", 0)]
    assert job(patience=1) == [("1", "C1", 0), ("2", None, 1)]


def test_new_files_join_the_waiting(spark, folder, job):
    job(matched=False)
    land(f"{folder}/in", "b.csv", [["3", *FEED[1][1:]]], SPEC)
    assert job() == [("1", "C1", 1)]
    assert job(close=True) == [("1", "C1", 1), ("2", None, 2), ("3", None, 2)]


def test_a_run_that_fails_before_its_commit_is_repeated(spark, folder, job, monkeypatch):
    write = op.write_out

    def fails(df, path, *args):
        if "/log/" in path:
            raise RuntimeError("lost")
        write(df, path, *args)

    monkeypatch.setattr(late.op, "write_out", fails)
    with pytest.raises(Exception, match="lost"):
        job()
    monkeypatch.undo()
    assert job() == [("1", "C1", 0)]
    assert job() == [("1", "C1", 0)]
    monkeypatch.setattr(late.op, "write_out", fails)
    with pytest.raises(RuntimeError, match="lost"):
        job(close=True)
    monkeypatch.undo()
    assert job(close=True) == [("1", "C1", 0), ("2", None, 2)]


def test_a_landing_folder_without_files(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    none = spark.createDataFrame([], RESPONSE)
    streaming.stream_late_feed(
        spark, f"{folder}/in", SPEC, "late_none", f"{folder}/state", "me", NOW, header=True,
        cleansing=none, matches=none,
    )
    assert streaming.open_records(spark, f"{folder}/state") is None


def test_a_sieve_loses_no_key_and_stays_small(spark):
    ids = spark.range(3_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    some = ids.where("id % 10 = 0")
    found = op.sift(ids, some, "k")
    assert some.join(found, "k", "left_anti").count() == 0
    assert found.count() < 330
    crowd = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert op.sieve(crowd, "k").count() <= WORDS
    assert op.sift(ids, some.where("false"), "k").count() == 0


def test_a_lost_checkpoint_leaves_the_table_equal(spark, folder):
    land(f"{folder}/in", "a.csv", FEED[:1], SPEC)
    none = spark.createDataFrame([], RESPONSE)

    def call(offsets):
        streaming.stream_feed(
            spark, f"{folder}/in", SPEC, name, f"{folder}/{offsets}", "me", NOW, header=True,
            cleansing=none, matches=none, table_path=f"{folder}/table", manifest=f"{folder}/files",
        )
        return rows(spark.table(name).select("SRC_ID", "SRC_INPUT_FILE_NAME"))

    name = f"replayed_{abs(hash(folder))}"
    call("first")
    land(f"{folder}/in", "b.csv", FEED[1:], SPEC)
    both = [("1", "a.csv"), ("2", "b.csv")]
    assert call("first") == both and call("second") == both and call("second") == both
    assert streaming.committed_rows(spark, name, f"{folder}/files").count() == 2
    # rows of a file that is not listed yet are not committed
    op.write_table(
        spark.table(name).withColumn("SRC_INPUT_FILE_NAME", F.lit("c.csv")), name,
        "overwrite_partitions", partition_by="SRC_INPUT_FILE_NAME",
    )
    assert spark.table(name).count() == 4
    assert streaming.committed_rows(spark, name, f"{folder}/files").count() == 2
