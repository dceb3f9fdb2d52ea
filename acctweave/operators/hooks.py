"""Partition hook for enrichments that need the caller's own Python client."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def enrich_partitions(
    df: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: T.StructType | str,
) -> DataFrame:
    """Run ``fn`` over each partition as a lazy stream of Arrow batches.

    ``fn`` may return any number of rows for each row it reads. Select the columns it needs first:
    everything in ``df`` crosses to the Python worker.
    """
    return df.mapInPandas(fn, schema)
