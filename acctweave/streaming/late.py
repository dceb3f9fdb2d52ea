"""A landing folder whose answers come late: records wait until they are answered.

State lies below one folder: ``open/run=N`` holds the prepared records that still wait after run N,
``log/run=N`` the line that commits the run, ``offsets`` the checkpoint of the file stream. A run
reads the records of the last committed run, never those of its own number, and replaces whatever an
attempt that failed has written under its number; so it may be repeated at any point.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave.operators.columns import RECORD_ID
from acctweave.plans.jobs import match_feed, prepare_feed, standardize_feed
from acctweave.specs import FeedSpec
from acctweave.streaming.landing import LANDED_FILE, landing_stream

SINCE = "_since"  # run that took a record up
READY = "_ready"
LOG = "source bigint, n_open bigint, n_settled bigint, run bigint"


def run_log(spark: SparkSession, state: str) -> DataFrame:
    """The committed runs: ``run``, batch of the file stream (null: none), records open and settled."""
    try:
        return spark.read.schema(LOG).parquet(f"{state}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def open_records(spark: SparkSession, state: str) -> DataFrame | None:
    """Prepared records that wait for an answer, with the run that took them up; None before any."""
    last = run_log(spark, state).agg(F.max("run")).first()[0]
    return None if last is None else spark.read.parquet(f"{state}/open/run={last}")


def _flagged(records: DataFrame, answers: list[DataFrame], overdue) -> DataFrame:
    """``records`` with ``READY``: all of ``answers`` hold an answer to them, or they are overdue."""
    flags = []
    for i, responses in enumerate(answers):
        flag = f"_answered_{i}"
        known = op.answers_for(records, responses).select(RECORD_ID).distinct()
        records = records.join(known.withColumn(flag, F.lit(True)), RECORD_ID, "left")
        flags.append(F.coalesce(flag, F.lit(False)))
    ready = reduce(lambda a, b: a & b, flags, F.lit(True)) | overdue
    return records.withColumn(READY, ready).drop(*(f"_answered_{i}" for i in range(len(answers))))


def stream_late_feed(
    spark: SparkSession,
    landing: str,
    spec: FeedSpec,
    table: str,
    state: str,
    user: str,
    now: datetime | None = None,
    header: bool | None = None,
    max_bytes: str | None = None,
    cleansing: DataFrame | None = None,
    addresses: DataFrame | None = None,
    matches: DataFrame | None = None,
    master: DataFrame | None = None,
    policy: str = "lenient",
    table_path: str | None = None,
    patience: int | None = None,
    close: bool = False,
) -> None:
    """``stream_feed`` for answers that may come after their records; one call is one or more runs.

    A record is settled, by the rules of the batch job, in the first run that finds an answer to it
    in each response table (``cleansing``, ``matches``); until then it waits in the state. Files that
    landed since the last call are taken up in runs of their own, and a call without new files makes
    one run for the waiting records alone. After ``patience`` runs, or with ``close``, a record is
    settled as one without an answer. Once nothing waits, the table holds the rows of the batch job
    over all files and answers; ``batch_id`` tells the run.

    A run reads the records that wait, not those settled before, and of the answers only those that
    can concern them. Answers that come after a record is settled do not change its rows.
    """

    def one_run(session: SparkSession, rows: DataFrame | None, source: int | None) -> None:
        log = run_log(session, state)
        if source is not None and log.where(F.col("source") == source).count():
            return  # committed before the stream could note it
        last = log.agg(F.max("run")).first()[0]
        run = 0 if last is None else last + 1
        parts = [] if last is None else [session.read.parquet(f"{state}/open/run={last}")]
        if rows is not None:
            prepared = prepare_feed(rows, F.col(LANDED_FILE), now, user).drop(LANDED_FILE)
            parts.append(prepared.withColumn(SINCE, F.lit(run).cast("bigint")))
        if not parts:
            return
        todo = op.hand_off(reduce(DataFrame.unionByName, parts), "taken-up")
        overdue = F.lit(close)
        if patience is not None:
            overdue = overdue | (run - F.col(SINCE) >= patience)
        answers = [a for a in (cleansing, matches) if a is not None]
        flagged = op.hand_off(_flagged(todo, answers, overdue), "flagged")
        ready = flagged.where(READY).drop(READY, SINCE)
        stage = standardize_feed(ready, spec, cleansing, addresses)
        if master is not None:
            stage = op.hand_off(stage)
        matched = match_feed(stage, matches, master, policy)
        op.write_table(
            matched.withColumn("batch_id", F.lit(run).cast("int")),
            table,
            mode="overwrite_partitions",
            path=table_path,
            partition_by="batch_id",
        )
        waiting = flagged.where(f"NOT {READY}").drop(READY)
        op.write_out(waiting, f"{state}/open/run={run}", "PARQUET")
        line = flagged.agg(
            F.lit(source).cast("bigint").alias("source"),
            F.count_if(~F.col(READY)).alias("n_open"),
            F.count_if(READY).alias("n_settled"),
        )
        op.write_out(line.coalesce(1), f"{state}/log/run={run}", "PARQUET")  # the commit

    sources = []

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        sources.append(batch_id)
        one_run(rows.sparkSession, rows, batch_id)

    query = (
        landing_stream(spark, landing, spec, header, max_bytes)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{state}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not sources:
        one_run(spark, None, None)
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
