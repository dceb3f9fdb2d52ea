"""Operators: every function takes DataFrames and returns a DataFrame."""

from acctweave.operators.columns import (
    add_audit,
    add_record_id,
    add_zip9,
    fill_blank,
    project_output,
)
from acctweave.operators.exchange import (
    FEED,
    answers_for,
    attach_cleansing,
    attach_matches,
    cleanse_requests,
    flatten_cleansing,
    latest_responses,
    match_features,
    match_requests,
    rejects,
)
from acctweave.operators.handoff import hand_off
from acctweave.operators.hooks import enrich_partitions
from acctweave.operators.layout import cap_rows, ordered_files, preview, sort_output, spread
from acctweave.operators.native import block_keys, match_accounts, standardize_accounts
from acctweave.operators.sieve import divide, sieve, sift
from acctweave.operators.sinks import DYNAMIC, write_out, write_table
from acctweave.operators.skew import skew_join

__all__ = [
    "DYNAMIC",
    "FEED",
    "add_audit",
    "add_record_id",
    "add_zip9",
    "answers_for",
    "attach_cleansing",
    "attach_matches",
    "block_keys",
    "cap_rows",
    "cleanse_requests",
    "divide",
    "enrich_partitions",
    "fill_blank",
    "flatten_cleansing",
    "hand_off",
    "latest_responses",
    "match_accounts",
    "match_features",
    "match_requests",
    "ordered_files",
    "preview",
    "project_output",
    "rejects",
    "sieve",
    "sift",
    "skew_join",
    "sort_output",
    "spread",
    "standardize_accounts",
    "write_out",
    "write_table",
]
