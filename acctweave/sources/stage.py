"""Hand-off between the two stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from acctweave.operators.sinks import FORMATS


def scan_stage(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    file_type: str = "PARQUET",
) -> DataFrame:
    """Read what ``write_out`` wrote.

    Text formats need ``schema``; Parquet and ORC carry their own. A CSV stage cannot tell null
    from '', which is why Parquet is the default.
    """
    source, options = FORMATS[file_type]
    if schema is None and source in ("csv", "json"):
        raise ValueError(f"a {file_type} stage needs its schema")
    reader = spark.read.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
