"""Order, row caps and partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

ORDER = ("SRC_ID", "BU_REC_ID", "ORG_ID")


def sort_output(df: DataFrame, keys: Sequence[str] = ORDER) -> DataFrame:
    """Global sort; the record and cluster ids break ties, and let one hot ``SRC_ID`` be split."""
    return df.orderBy(*(k for k in keys if k in df.columns))


def cap_rows(df: DataFrame, n: int, keys: Sequence[str] = ORDER) -> DataFrame:
    """The first ``n`` rows in key order, so that a rerun caps to the same rows."""
    return sort_output(df, keys).limit(n)


def spread(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Redistribute over ``n`` partitions, evenly, or by ``keys`` when given."""
    return df.repartition(n, *keys)


def ordered_files(df: DataFrame, keys: Sequence[str] = ORDER) -> DataFrame:
    """Lay rows out so that the part files, in name order, hold one sorted output.

    A result that fits one advisory-size partition becomes a single file, as adaptive execution
    merges its ranges; a larger one becomes several, so no task ever holds the whole output.
    """
    present = [k for k in keys if k in df.columns]
    return df.repartitionByRange(*present).sortWithinPartitions(*present)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, all columns untruncated, as a DataFrame."""
    return df.limit(n)
