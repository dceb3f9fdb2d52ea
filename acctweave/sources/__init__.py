"""Batch scans."""

from acctweave.sources.checked import (
    check_lines,
    feed_lines,
    scan_checked,
    scan_rejects,
    sound_rows,
)
from acctweave.sources.delimited import scan_delimited, scan_feed
from acctweave.sources.stage import scan_stage

__all__ = [
    "check_lines",
    "feed_lines",
    "scan_checked",
    "scan_delimited",
    "scan_feed",
    "scan_rejects",
    "scan_stage",
    "sound_rows",
]
