"""Landing-folder streams."""

from acctweave.streaming.landing import (
    committed_rows,
    ingest_checked,
    ingest_landing,
    landing_stream,
    stream_feed,
)
from acctweave.streaming.late import open_records, run_log, stream_late_feed

__all__ = [
    "committed_rows",
    "ingest_checked",
    "ingest_landing",
    "landing_stream",
    "open_records",
    "run_log",
    "stream_feed",
    "stream_late_feed",
]
