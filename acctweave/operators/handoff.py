"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from acctweave.operators.sinks import write_out
from acctweave.scratch import shared_dir


def hand_off(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the written rows.

    Cuts the plan where a later step reads its input more than once, and survives lost executors.
    """
    path = shared_dir(df.sparkSession, name)
    write_out(df, path, "PARQUET")
    return df.sparkSession.read.schema(df.schema).parquet(path)
