"""One query per operator: ``(spark, sf_dir) -> DataFrame``, each over the whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctweave import operators as op
from acctweave import plans, sources, streaming
from acctweave.functions import parse_match_body
from acctweave.scratch import shared_dir
from acctweave.specs import AuditSpec
from workload import tables as t

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- columns ----


@query
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.add_audit(t.accounts(spark, sf_dir), AuditSpec.default(), t.FILE, t.NOW, t.USER)
    return df.select("SRC_ID", "SRC_TP_CD", *(name for name, _ in AuditSpec.default().fields))


@query
def ordered_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.project_output(t.own_standard(spark, sf_dir), t.SPEC)


@query
def record_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.add_record_id(t.accounts(spark, sf_dir), "hash")
    return df.select("BU_REC_ID", "SRC_TP_CD", "SRC_ID")


@query
def record_id_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in which keys repeat, with equal rows and with others; every row has its own id."""
    rows, k = t.accounts(spark, sf_dir), F.col("SRC_ID").cast("bigint")
    renamed = [
        rows.where(k % 10 == 1).withColumn("ORG_NAME", F.concat("ORG_NAME", F.lit(f" {i}")))
        for i in range(2)
    ]
    feed = rows.unionAll(rows.where(k % 10 == 0)).unionAll(renamed[0]).unionAll(renamed[1])
    ids = op.add_record_id(op.hand_off(feed, "feed"), "numbered")
    return ids.select("BU_REC_ID", "SRC_TP_CD", "SRC_ID")


@query
def record_id_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    df = op.add_record_id(t.accounts(spark, sf_dir).select("SRC_ID"), "uuid")
    # unique ids are told by the largest repeat count, a two-step aggregate over all ids
    per_id = df.groupBy("BU_REC_ID").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_per_id"),
        F.count_if(F.rlike("BU_REC_ID", F.lit(pattern))).alias("n_version_4"),
    )


@query
def blank_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("SRC_ID").cast("bigint")
    return op.fill_blank(t.accounts(spark, sf_dir).withColumn("NUMBER", F.when(k % 5 != 0, k)))


@query
def zip9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_zip9(t.stage(spark, sf_dir)).select("BU_REC_ID", "STD_ORG_ZIP9")


# ---- matching exchange ----

ABSENT = ("site_fax", "EMAIL")


def _filled_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fill_blank(op.add_zip9(t.stage(spark, sf_dir)))


def _scalars(record: DataFrame) -> list[Column]:
    names = record.schema["record"].dataType.names
    return [F.get(F.col(f"record.{n}"), F.lit(0)).alias(n) for n in names]


@query
def match_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = op.match_features(_filled_stage(spark, sf_dir))
    return features.select("recordId", *_scalars(features))


@query
def match_request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _filled_stage(spark, sf_dir)
    kind = op.match_features(stage).schema.simpleString()
    parsed = op.match_requests(stage).select(
        F.from_json("request", kind).alias("doc"),
        *(F.contains("request", F.lit(f'"{n}":null')).alias(f"{n}_sent") for n in ABSENT),
    )
    flat = parsed.select("doc.recordId", "doc.record", *(f"{n}_sent" for n in ABSENT))
    return flat.select("recordId", *_scalars(flat), *(f"{n}_sent" for n in ABSENT))


@query
def parse_match_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = t.match_responses(spark, sf_dir).select(
        "BU_REC_ID", "received_at", "status", parse_match_body(F.col("body")).alias("hits")
    )
    return clusters.select(
        "BU_REC_ID",
        "received_at",
        "status",
        F.col("hits").isNotNull().alias("well_formed"),
        F.posexplode_outer("hits").alias("pos", "hit"),
    ).select("BU_REC_ID", "received_at", "status", "well_formed", "pos", "hit.*")


@query
def latest_match_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = op.latest_responses(t.match_responses(spark, sf_dir))
    return latest.select("BU_REC_ID", "status", F.length("body").cast("bigint").alias("body_length"))


MATCHED = ("BU_REC_ID", "SRC_ID", "STD_ORG_ZIP9", "ORG_ID", "ORG_MATCH_CONFIDENCE")


@query
def attach_matches_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, answers = _filled_stage(spark, sf_dir), t.match_responses(spark, sf_dir)
    return op.attach_matches(stage, answers, "lenient").select(*MATCHED)


@query
def attach_matches_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, answers = _filled_stage(spark, sf_dir), t.match_responses(spark, sf_dir)
    return op.attach_matches(stage, answers, "strict").select(*MATCHED)


@query
def rejects_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.match_requests(_filled_stage(spark, sf_dir))
    return op.rejects(t.match_responses(spark, sf_dir), "match", requests=requests)


# ---- cleansing exchange ----


@query
def cleanse_request_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cleanse_requests(op.add_record_id(t.accounts(spark, sf_dir), "hash"), "ACCOUNTS")


@query
def cleanse_request_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cleanse_requests(t.contacts(spark, sf_dir), "CONTACT")


@query
def flatten_cleansing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.flatten_cleansing(op.latest_responses(t.cleansing_responses(spark, sf_dir)))


@query
def flatten_cleansing_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = t.cleansing_responses(spark, sf_dir, "CONTACT")
    return op.flatten_cleansing(op.latest_responses(answers), "CONTACT")


@query
def attach_cleansing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.attach_cleansing(t.prepared(spark, sf_dir), t.cleansing_responses(spark, sf_dir))


@query
def attach_cleansing_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = t.cleansing_responses(spark, sf_dir, "CONTACT")
    return op.attach_cleansing(t.contacts(spark, sf_dir), answers, "CONTACT")


@query
def rejects_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.cleanse_requests(t.prepared(spark, sf_dir))
    return op.rejects(t.cleansing_responses(spark, sf_dir), "cleanse", requests=requests)


# ---- native operators ----


@query
def standardize_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.standardize_accounts(t.prepared(spark, sf_dir), t.address_reference(spark, sf_dir))


def _rounded(matched: DataFrame) -> DataFrame:
    return matched.select(
        "BU_REC_ID", "ORG_ID", F.round("ORG_MATCH_CONFIDENCE", 6).alias("ORG_MATCH_CONFIDENCE")
    )


@query
def match_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, master = _filled_stage(spark, sf_dir), t.cluster_master(spark, sf_dir)
    return _rounded(op.match_accounts(stage, master))


@query
def match_native_confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, master = _filled_stage(spark, sf_dir), t.cluster_master(spark, sf_dir)
    return _rounded(op.match_accounts(stage, master, min_score=0.95))


# ---- order, caps, layout ----


@query
def sorted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted rows with the place each one takes in the order."""
    once = shared_dir(spark, "sorted")
    keys = ("SRC_ID", "BU_REC_ID")
    op.write_out(op.sort_output(t.stage(spark, sf_dir).select(*keys), keys), once, "PARQUET")
    # rank inside each sorted file, plus the rows of the files before it
    rows = spark.read.parquet(once).select(
        *keys,
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # one row per part file
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("file", F.coalesce(before, F.lit(0)).alias("start"))
    return rows.join(starts, "file").select(
        *keys, (F.col("start") + F.col("row") + 1).cast("bigint").alias("place")
    )


@query
def capped_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cap_rows(t.stage(spark, sf_dir), 50).select("SRC_ID", "BU_REC_ID", "SRC_ORG_NAME")


@query
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.stage(spark, sf_dir).select("SRC_ID", "BU_REC_ID", "SRC_ORG_NAME")
    return op.preview(op.sort_output(rows))


def _shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("SRC_ID").cast("bigint")).alias("sum_of_ids"),
        F.sum(F.length("STD_ORG_NAME").cast("bigint")).alias("name_characters"),
    )


@query
def spread_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(op.spread(t.stage(spark, sf_dir), 10))


@query
def spread_by_key_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(op.spread(t.stage(spark, sf_dir), 10, "BU_REC_ID"))


@query
def ordered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written, and the part files whose ids start before those of the file ahead end."""
    once = shared_dir(spark, "ordered")
    op.write_out(op.ordered_files(t.stage(spark, sf_dir)), once, "PARQUET")
    files = (
        spark.read.parquet(once)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("SRC_ID").alias("first"),
            F.max("SRC_ID").alias("last"),
        )
    )
    # one row per part file
    ahead = files.select(
        "n", (F.lag("last").over(Window.orderBy("file")) > F.col("first")).alias("overlaps")
    )
    return ahead.agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("overlaps")).alias("n_out_of_order")
    )


# ---- sinks and scans ----


def _round_trip(spark: SparkSession, sf_dir: str, file_type: str) -> DataFrame:
    stage = t.stage(spark, sf_dir)
    path = shared_dir(spark, f"sink-{file_type.lower()}")
    op.write_out(stage, path, file_type)
    return op.fill_blank(sources.scan_stage(spark, path, stage.schema, file_type))


@query
def sink_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "CSV")


@query
def sink_roundtrip_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "TAB")


@query
def sink_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "PARQUET")


@query
def sink_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "JSON")


@query
def sink_roundtrip_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "ORC")


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


@query
def sink_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "table")
    op.write_table(t.stage(spark, sf_dir), _table_name(path), path=path)
    return op.fill_blank(spark.table(_table_name(path)))


@query
def sink_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "table")
    rows = t.stage(spark, sf_dir).select("BU_REC_ID", "SRC_ID")
    for mode in ("overwrite", "append"):
        op.write_table(rows, _table_name(path), mode, path=path)
    return spark.table(_table_name(path))


@query
def scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "feed")
    op.write_out(t.accounts(spark, sf_dir), path, "CSV")
    inferred = sources.scan_delimited(spark, path)
    numbers = ("SRC_ID", "ORG_ZIP_CODE", "ORG_ZIP_SUPP", "ORG_PHONE_NUMBER")
    return inferred.withColumns({n: F.col(n).cast("bigint") for n in numbers})


@query
def scan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "feed")
    op.write_out(t.accounts(spark, sf_dir), path, "CSV")
    return sources.scan_feed(spark, path, t.SPEC, header=True)


def _write_lines(df: DataFrame, line: Column, header: list[str], path: str) -> None:
    """``line`` of every row as it is, in files that start with ``header``."""
    named = df.select(F.explode(F.split(line, "\n")).alias(",".join(header)))
    options = {"sep": "\x01", "quote": "", "header": "true"}
    named.write.options(**options).mode("append").csv(path)


def _land_damaged(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customers with a line that is short, surplus or left open now and then; suppliers misnamed."""
    names = t.SPEC.schema.names
    whole = F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in names))
    k, supplier = F.col("SRC_ID").cast("bigint"), F.col("SRC_TP_CD") == "SUPPLIER"
    damaged = (
        F.when(k % 10 == 0, F.concat_ws(",", "SRC_ID", "SRC_TP_CD"))
        .when(k % 10 == 1, F.concat(whole, F.lit(",more")))
        .when(k % 10 == 2, F.concat(whole, F.lit('"open')))
        .when(k % 10 == 3, F.concat(F.lit('"'), "SRC_ID", F.lit('\n",'), "SRC_TP_CD"))
        .otherwise(whole)
    )
    rows = t.accounts(spark, sf_dir)
    _write_lines(rows.where(~supplier), damaged, names, path)
    _write_lines(rows.where(supplier), whole, names[::-1], path)


@query
def rejects_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of damaged files, as a row or as a reject."""
    path = shared_dir(spark, "feed")
    _land_damaged(spark, sf_dir, path)
    checked = sources.scan_checked(spark, path, t.SPEC, header=True)
    rows = sources.sound_rows(checked).select(
        F.lit("row").alias("kind"), F.concat_ws(",", "SRC_ID", "ORG_NAME", "ORG_WEBSITE").alias("line")
    )
    refused = sources.scan_rejects(checked)
    return rows.unionByName(
        # each misnamed file, as many as its writer made, has its header among the rejects
        refused.where(F.col("REJECT_LINE") != ",".join(t.SPEC.schema.names[::-1])).select(F.col("REJECT_REASON").alias("kind"), F.col("REJECT_LINE").alias("line"))
    )


@query
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over damaged files and a misnamed one: rows, rejects and the files' manifest."""
    landing, out, bad, files, offsets = (
        shared_dir(spark, n) for n in ("landing", "ingested", "refused", "manifest", "offsets")
    )
    _land(spark, sf_dir, landing, "suppliers")
    for damaged in (True, False):  # the last run finds nothing new
        if damaged:
            _land_damaged(spark, sf_dir, landing)
        streaming.ingest_checked(spark, landing, t.SPEC, out, bad, files, offsets, header=True)
    rows = spark.read.parquet(out)
    refused = spark.read.parquet(bad).where(
        F.col("REJECT_LINE") != ",".join(t.SPEC.schema.names[::-1])
    )
    listed = spark.read.parquet(files)
    headers = F.count_if(F.col("status") == "quarantined")  # rejects, too; as many as files
    totals = listed.agg(
        F.sum("n_rows").alias("a"), (F.sum("n_rejects") - headers).alias("b")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("listed rows").alias("kind"), F.col("a").alias("n")),
                F.struct(F.lit("listed rejects").alias("kind"), F.col("b").alias("n")),
            )
        )
    )
    return (
        rows.groupBy(F.col("SRC_TP_CD").alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"))
        .unionAll(refused.groupBy("REJECT_REASON").agg(F.count(F.lit(1))))
        .unionAll(totals)
    )


@query
def stage_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "handoff")
    op.write_out(t.stage(spark, sf_dir), path, "PARQUET")
    return sources.scan_stage(spark, path, t.SPEC.stage_schema)


# ---- hook ----


@query
def partition_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    def zero_to_two(batches):
        for batch in batches:
            number = batch["SRC_ID"].astype("int64")
            copies = batch.loc[batch.index.repeat(number % 3)]
            yield pd.DataFrame(
                {"BU_REC_ID": copies["BU_REC_ID"], "NAME_LENGTH": copies["STD_ORG_NAME"].str.len()}
            )

    rows = t.stage(spark, sf_dir).select("BU_REC_ID", "SRC_ID", "STD_ORG_NAME")
    return op.enrich_partitions(rows, zero_to_two, "BU_REC_ID string, NAME_LENGTH bigint")


# ---- jobs ----


@query
def standardize_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = t.cleansing_responses(spark, sf_dir)
    return plans.standardize_feed(t.prepared(spark, sf_dir), t.SPEC, responses=answers)


@query
def standardize_feed_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = t.address_reference(spark, sf_dir)
    return plans.standardize_feed(t.prepared(spark, sf_dir), t.SPEC, addresses=addresses)


@query
def match_feed_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.match_feed(standardize_feed(spark, sf_dir), t.match_responses(spark, sf_dir))


@query
def match_feed_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = t.match_responses(spark, sf_dir)
    return plans.match_feed(standardize_feed(spark, sf_dir), answers, policy="strict", cap=50)


@query
def match_feed_strict_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = t.match_responses(spark, sf_dir)
    return plans.match_feed(standardize_feed(spark, sf_dir), answers, policy="strict")


@query
def standardize_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standardize job for a contact feed."""
    contacts, answers = t.contacts(spark, sf_dir), t.cleansing_responses(spark, sf_dir, "CONTACT")
    return plans.standardize_feed(contacts, t.CONTACT_SPEC, responses=answers)


@query
def match_feed_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = t.cluster_master(spark, sf_dir)
    stage = op.hand_off(standardize_feed_native(spark, sf_dir))
    return _rounded(plans.match_feed(stage, master=master))


@query
def publish_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sinks of the match job, read back: CSV rows next to table rows."""
    path, table_path = shared_dir(spark, "out"), shared_dir(spark, "warehouse")
    name = _table_name(table_path)
    matched = match_feed_lenient(spark, sf_dir)
    plans.publish(matched, path, name, path=table_path)
    written = {
        "csv": sources.scan_stage(spark, path, matched.schema, "CSV"),
        "table": spark.table(name),
    }
    kept = [
        df.select(F.lit(sink).alias("sink"), "BU_REC_ID", "ORG_ID", "ORG_MATCH_CONFIDENCE")
        for sink, df in written.items()
    ]
    return kept[0].unionByName(kept[1])


# ---- streams ----


def _land(spark: SparkSession, sf_dir: str, landing: str, kind: str) -> None:
    """Land the customers or the suppliers as one more batch of files."""
    rows = t.accounts(spark, sf_dir)
    supplier = F.col("SRC_TP_CD") == "SUPPLIER"
    op.write_out(rows.where(supplier if kind == "suppliers" else ~supplier), landing, mode="append")


@query
def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, out, checkpoint = (shared_dir(spark, n) for n in ("landing", "ingested", "offsets"))
    for kind in ("customers", "suppliers", None):  # the last run finds nothing new
        if kind:
            _land(spark, sf_dir, landing, kind)
        streaming.ingest_landing(spark, landing, t.SPEC, out, checkpoint, header=True)
    tagged = F.col(streaming.landing.LANDED_FILE).endswith(".csv").alias("tagged")
    return spark.read.parquet(out).select(*t.SPEC.schema.names, tagged)


@query
def stream_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, out, checkpoint = (shared_dir(spark, n) for n in ("landing", "streamed", "offsets"))
    name = _table_name(out)
    for kind in ("customers", "suppliers", None):
        if kind:
            _land(spark, sf_dir, landing, kind)
        streaming.stream_feed(
            spark,
            landing,
            t.SPEC,
            name,
            checkpoint,
            user=t.USER,
            now=t.NOW,
            header=True,
            cleansing=t.cleansing_responses(spark, sf_dir),
            matches=t.match_responses(spark, sf_dir),
            table_path=out,
        )
    tagged = F.col("SRC_INPUT_FILE_NAME").endswith(".csv").alias("tagged")
    return spark.table(name).select("*", tagged).drop("SRC_INPUT_FILE_NAME")


@query
def stream_feed_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream loses its checkpoint after the second file set and reads all files once more."""
    landing, out, manifest = (shared_dir(spark, n) for n in ("landing", "streamed", "manifest"))
    first, second = shared_dir(spark, "offsets"), shared_dir(spark, "offsets")
    name = _table_name(out)
    for kind, checkpoint in (("customers", first), ("suppliers", first), (None, second)):
        if kind:
            _land(spark, sf_dir, landing, kind)
        streaming.stream_feed(
            spark,
            landing,
            t.SPEC,
            name,
            checkpoint,
            user=t.USER,
            now=t.NOW,
            header=True,
            cleansing=t.cleansing_responses(spark, sf_dir),
            matches=t.match_responses(spark, sf_dir),
            table_path=out,
            manifest=manifest,
        )
    tagged = F.col("SRC_INPUT_FILE_NAME").endswith(".csv").alias("tagged")
    whole = streaming.committed_rows(spark, name, manifest)
    return whole.select("*", tagged).drop("SRC_INPUT_FILE_NAME")


@query
def stream_late_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers land after their records: at first none, then some, then all; the rest is given up."""
    landing, out, state = (shared_dir(spark, n) for n in ("landing", "late", "state"))
    name = _table_name(out)
    cleansing, matches = t.cleansing_responses(spark, sf_dir), t.match_responses(spark, sf_dir)
    some = matches.where("BU_REC_ID < '8'")
    for kind, arrived, close in (
        ("customers", (cleansing.where("false"), matches.where("false")), False),
        ("suppliers", (cleansing, some), False),
        (None, (cleansing, matches), False),
        (None, (cleansing, matches), True),
    ):
        if kind:
            _land(spark, sf_dir, landing, kind)
        streaming.stream_late_feed(
            spark,
            landing,
            t.SPEC,
            name,
            state,
            user=t.USER,
            now=t.NOW,
            header=True,
            cleansing=arrived[0],
            matches=arrived[1],
            table_path=out,
            close=close,
        )
    tagged = F.col("SRC_INPUT_FILE_NAME").endswith(".csv").alias("tagged")
    return spark.table(name).select("*", tagged).drop("SRC_INPUT_FILE_NAME")
