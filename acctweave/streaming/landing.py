"""Structured Streaming over a landing folder: every file that arrives is read exactly once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave.plans.jobs import match_feed, prepare_feed, standardize_feed
from acctweave.sources import check_lines
from acctweave.sources.checked import FILE, LINE_SCHEMA, RAW, REASON, LINE, line_options
from acctweave.sources.delimited import feed_options
from acctweave.specs import FeedSpec

LANDED_FILE = FILE


#: Output column that holds the name of a record's file.
FILE_COLUMN = "SRC_INPUT_FILE_NAME"


def committed_rows(spark: SparkSession, table: str, manifest: str) -> DataFrame:
    """Rows of ``table`` whose file is listed: none of a file that a stream has half written."""
    schema = f"n_rows bigint, batch_id int, {FILE_COLUMN} string"
    listed = spark.read.schema(schema).parquet(manifest).select(FILE_COLUMN)
    return spark.table(table).join(listed, FILE_COLUMN, "left_semi")


def landing_stream(
    spark: SparkSession,
    landing: str,
    spec: FeedSpec,
    header: bool | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Unbounded rows of the files in ``landing``, each tagged with the name of its file.

    ``max_bytes`` (such as '1t') bounds one micro-batch when a backlog has built up.
    """
    reader = spark.readStream.schema(spec.schema).options(**feed_options(spec, header))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.csv(landing).select("*", F.col("_metadata.file_name").alias(LANDED_FILE))


def ingest_landing(
    spark: SparkSession,
    landing: str,
    spec: FeedSpec,
    out: str,
    checkpoint: str,
    header: bool | None = None,
    max_bytes: str | None = None,
) -> None:
    """Append all files that arrived since the last run to the Parquet table ``out``, then stop.

    The checkpoint remembers the files read and the sink's log the batches written, so a run that
    fails half-way adds nothing twice.
    """
    stream = landing_stream(spark, landing, spec, header, max_bytes)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_checked(
    spark: SparkSession,
    landing: str,
    spec: FeedSpec,
    out: str,
    rejects: str,
    manifest: str,
    checkpoint: str,
    header: bool | None = None,
    max_bytes: str | None = None,
) -> None:
    """``ingest_landing`` that no file can stop: what is no record of the spec goes to ``rejects``.

    Every file that arrived is checked by itself (see ``check_lines``); one with a wrong header is
    rejected whole, and the others go on. ``manifest`` gets a row per file: its rows, its rejects and
    its status, 'ingested', 'partly' or 'quarantined'. All three hold a folder for each batch, which
    a batch that is repeated after a failure replaces, the manifest last.
    """
    reader = spark.readStream.schema(LINE_SCHEMA).options(**line_options(spec))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    lines = reader.csv(landing).select(
        F.coalesce(RAW, "line").alias(LINE), F.col("_metadata.file_name").alias(FILE)
    )

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        checked = op.hand_off(check_lines(rows, spec, header), "checked")
        refused = F.col(REASON).isNotNull()
        sound = checked.where(~refused).drop(REASON, LINE)
        op.write_out(sound, f"{out}/batch_id={batch_id}", "PARQUET")
        bad = checked.where(refused).select(FILE, REASON, LINE)
        op.write_out(bad, f"{rejects}/batch_id={batch_id}", "PARQUET")
        files = checked.groupBy(FILE).agg(
            F.count_if(~refused).alias("n_rows"), F.count_if(refused).alias("n_rejects")
        )
        status = (
            F.when(F.col("n_rejects") == 0, "ingested")
            .when(F.col("n_rows") == 0, "quarantined")
            .otherwise("partly")
        )
        listed = files.withColumn("status", status)
        op.write_out(listed, f"{manifest}/batch_id={batch_id}", "PARQUET")

    query = (
        lines.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_feed(
    spark: SparkSession,
    landing: str,
    spec: FeedSpec,
    table: str,
    checkpoint: str,
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
    manifest: str | None = None,
) -> None:
    """Standardize and match all files that arrived since the last run, into ``table``, then stop.

    Each micro-batch is the batch job on the newly landed rows, joined with the response or
    reference tables as they then stand. It replaces the partition ``batch_id`` of its own number,
    so a batch repeated after a failure leaves the table as one run would.

    With ``manifest``, the table is partitioned by the landed file (``FILE_COLUMN``) in place of the
    batch, and a batch replaces the partitions of its files: also a stream that has lost its
    checkpoint, and reads all files anew, leaves the table as one run would. ``manifest`` gets a row
    for each file after its rows are written; ``committed_rows`` reads the rows of listed files.
    """

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        prepared = prepare_feed(rows, F.col(LANDED_FILE), now, user).drop(LANDED_FILE)
        if addresses is not None:
            prepared = op.hand_off(prepared, "prepared")
        stage = standardize_feed(prepared, spec, cleansing, addresses)
        if master is not None:
            stage = op.hand_off(stage)
        matched = match_feed(stage, matches, master, policy)
        if manifest is None:
            matched = matched.withColumn("batch_id", F.lit(batch_id))
        else:
            matched = op.hand_off(matched, "matched")  # written to the table and counted
        op.write_table(
            matched,
            table,
            mode="overwrite_partitions",
            path=table_path,
            partition_by="batch_id" if manifest is None else FILE_COLUMN,
        )
        if manifest is not None:
            listed = matched.groupBy(FILE_COLUMN).agg(
                F.count(F.lit(1)).alias("n_rows"), F.lit(batch_id).alias("batch_id")
            )
            writer = listed.write.options(**op.DYNAMIC).partitionBy(FILE_COLUMN)
            writer.mode("overwrite").parquet(manifest)

    query = (
        landing_stream(spark, landing, spec, header, max_bytes)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if spark.catalog.tableExists(table):  # batches write through a session of their own
        spark.catalog.refreshTable(table)
