"""Audit columns, record ids, blanks, ZIP+4 and the output projection (narrow but for numbered ids)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from acctweave.operators.sieve import divide
from acctweave.specs import AuditSpec, FeedSpec

RECORD_ID = "BU_REC_ID"
CLOCK = "yyyy-MMM-dd HH:mm:ss"


def add_audit(
    df: DataFrame,
    spec: AuditSpec,
    file_name: str | Column,
    now: datetime | None,
    user: str,
) -> DataFrame:
    """Add the audit columns in spec order.

    Tokens are replaced one after the other (file name, date, user), so a token inside a replaced
    value is itself replaced. ``file_name`` may be a column, such as the name of a landed file;
    without ``now`` the clock of the query is used.
    """
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    clock = F.date_format(F.current_timestamp() if now is None else F.lit(now), CLOCK)
    tokens = {"{INPUT_FILE_NAME}": name, "{CURRENT_DATE}": clock, "{CURRENT_USER}": F.lit(user)}

    def filled(template: str) -> Column:
        value = F.lit(template)
        for token, replacement in tokens.items():
            value = F.replace(value, F.lit(token), replacement)
        return value

    return df.withColumns({field: filled(template) for field, template in spec.fields})


def add_record_id(
    df: DataFrame, mode: str = "uuid", keys: Sequence[str] = ("SRC_TP_CD", "SRC_ID")
) -> DataFrame:
    """Add ``BU_REC_ID``.

    ``uuid`` draws random ids: write the result before using the ids twice, as a recomputed plan
    draws others. ``hash`` derives the id from ``keys``, which must be unique within the feed; it
    survives reruns and lost executors unchanged. ``numbered`` is ``hash`` for feeds in which keys
    repeat: the first row of a key has its plain id, the others ids of their own (see
    ``_numbered``); hand over a stored table.
    """
    if mode == "uuid":
        return df.withColumn(RECORD_ID, F.uuid())
    if mode == "hash":
        return df.withColumn(RECORD_ID, F.md5(_encoded(keys)))
    if mode == "numbered":
        return _numbered(df, keys)
    raise ValueError(f"id mode must be 'uuid', 'hash' or 'numbered', not {mode!r}")


def _encoded(keys: Sequence[str]) -> Column:
    """``keys`` as one text: every value behind its length, and a mark of its own for null.

    Two rows have the same text only if all their keys are equal; null and '' differ.
    """

    def told(value: Column) -> Column:
        return F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(value).cast("string"), F.lit(":"), value)
        )

    return F.concat(*(told(F.col(k).cast("string")) for k in keys))


BUCKETS = 256  # stretches of content hashes that the rows of one key are counted in


def _numbered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ids that are unique in it and the same in every run over the same rows.

    Rows of one key are numbered from 0 in the order of their contents. Copies are counted before
    they are shuffled, and the numbers come in two levels, the rows before a bucket of content hashes
    and those before a row in it, so that no task gets all rows of a key. A bounded filter over the
    repeated keys lets the rows of all other keys, mostly all of the feed, pass unshuffled.
    """
    place, bucket, copies, before = (f"_{n}" for n in ("place", "bucket", "copies", "before"))
    columns = df.columns
    plain = df.withColumn(RECORD_ID, F.md5(_encoded(keys)))
    repeated = plain.groupBy(RECORD_ID).agg(F.count(F.lit(1)).alias(copies)).where(f"{copies} > 1")
    unique, shared = divide(plain, repeated, RECORD_ID)

    distinct = (
        shared.groupBy(*columns, RECORD_ID)
        .agg(F.count(F.lit(1)).alias(copies))
        .withColumn(place, F.xxhash64(*columns))
        .withColumn(bucket, F.shiftright(place, 64 - (BUCKETS.bit_length() - 1)))
    )
    whole = (
        distinct.groupBy(RECORD_ID, bucket)
        .agg(F.sum(copies).alias("_n"))
        .withColumn(before, _sum_before("_n", Window.partitionBy(RECORD_ID).orderBy(bucket)))
        .drop("_n")
    )
    inside = Window.partitionBy(RECORD_ID, bucket).orderBy(place, *columns)
    numbered = (
        distinct.withColumn("_inside", _sum_before(copies, inside))
        .join(whole, [RECORD_ID, bucket])
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1)))
        .withColumn("_number", F.col(before) + F.col("_inside") + F.col("_copy"))
    )
    later = F.md5(F.concat(F.col(RECORD_ID), F.lit("#"), F.col("_number").cast("string")))
    ids = F.when(F.col("_number") == 0, F.col(RECORD_ID)).otherwise(later)
    return unique.unionByName(numbered.select(*columns, ids.alias(RECORD_ID)))


def _sum_before(column: str, window: WindowSpec) -> Column:
    rows = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(rows), F.lit(0))


def fill_blank(df: DataFrame) -> DataFrame:
    """Null to '' in the string columns only."""
    return df.fillna("")


def add_zip9(df: DataFrame) -> DataFrame:
    """Join ZIP and supplement with a dash, skipping nulls; run it before ``fill_blank``."""
    return df.withColumn("STD_ORG_ZIP9", F.concat_ws("-", "STD_ORG_ZIP_CODE", "STD_ORG_ZIP_SUPP"))


def project_output(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Select and rename to the output layout, in position order."""
    return df.selectExpr(*(f"`{source}` AS `{target}`" for source, target in spec.outputs))
