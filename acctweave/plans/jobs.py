"""The standardize and match jobs, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame

from acctweave import operators as op
from acctweave.specs import AuditSpec, FeedSpec


def prepare_feed(
    feed: DataFrame,
    file_name: str | Column,
    now: datetime | None,
    user: str,
    audit: AuditSpec | None = None,
    id_mode: str = "hash",
    id_keys: Sequence[str] = ("SRC_TP_CD", "SRC_ID"),
) -> DataFrame:
    """Audit columns, record id and blanks: the records that requests are made from.

    With ``id_mode='uuid'`` write the result and go on from the written rows, since answers are
    joined on ids that a recomputed plan would draw anew.
    """
    stamped = op.add_audit(feed, audit or AuditSpec.default(), file_name, now, user)
    return op.fill_blank(op.add_record_id(stamped, id_mode, id_keys))


def standardize_feed(
    prepared: DataFrame,
    spec: FeedSpec,
    responses: DataFrame | None = None,
    addresses: DataFrame | None = None,
) -> DataFrame:
    """Prepared records in the standardized layout.

    ``STD_*`` columns come from cleansing ``responses``, or from a reference table of ``addresses``.
    """
    if (responses is None) == (addresses is None):
        raise ValueError("give either responses or addresses")
    if responses is not None:
        enriched = op.attach_cleansing(prepared, responses, spec.process_type)
    else:
        enriched = op.standardize_accounts(prepared, addresses)
    return op.project_output(enriched, spec)


def match_feed(
    stage: DataFrame,
    responses: DataFrame | None = None,
    master: DataFrame | None = None,
    policy: str = "lenient",
    cap: int | None = None,
    min_score: float = 0.0,
) -> DataFrame:
    """Standardized records with ``STD_ORG_ZIP9``, ``ORG_ID`` and ``ORG_MATCH_CONFIDENCE``.

    Matches come from service ``responses`` under ``policy``, or from a cluster ``master``, where
    'strict' leaves out the records without a match; ``stage`` is then read more than once and
    should be a stored table. ``cap`` keeps the first records only, for trial runs.
    """
    if (responses is None) == (master is None):
        raise ValueError("give either responses or master")
    records = stage if cap is None else op.cap_rows(stage, cap)
    records = op.fill_blank(op.add_zip9(records))
    if responses is not None:
        return op.attach_matches(records, responses, policy)
    matched = op.match_accounts(records, master, min_score)
    return matched.where("ORG_ID IS NOT NULL") if policy == "strict" else matched


def publish(
    matched: DataFrame,
    out: str,
    table: str | None = None,
    file_type: str = "CSV",
    **table_options,
) -> DataFrame:
    """Write ordered files below ``out`` and, if named, a table; return the written rows.

    The result is computed once, into the shared folder, and both sinks read it from there: a lost
    executor costs its own tasks, never a second run of the whole job.
    """
    written = op.hand_off(matched, "matched")
    op.write_out(op.ordered_files(written), out, file_type)
    if table is not None:
        op.write_table(written, table, **table_options)
    return written
