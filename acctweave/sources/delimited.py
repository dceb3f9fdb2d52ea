"""Delimited files: with inferred types, or read by a feed spec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctweave.specs import FeedSpec


def scan_delimited(spark: SparkSession, path: str, infer: bool = True, sep: str = ",") -> DataFrame:
    """Header row, types inferred from the data.

    Inference reads the input once more and turns codes into numbers (ZIP 07030 becomes 7030); use
    ``infer=False`` to keep all columns as text, or ``scan_feed``.
    """
    return spark.read.csv(path, header=True, inferSchema=infer, sep=sep)


def feed_options(spec: FeedSpec, header: bool | None = None) -> dict[str, str]:
    """Reader options of a spec; ``header`` overrides its header flag.

    With a header the names in it are checked against the spec, so a wrong file fails.
    """
    has_header = spec.has_header if header is None else header
    options = {"sep": spec.delimiter, "encoding": spec.encoding, "header": str(has_header).lower()}
    if has_header:
        options["enforceSchema"] = "false"
    return options


def scan_feed(
    spark: SparkSession, path: str, spec: FeedSpec, header: bool | None = None
) -> DataFrame:
    """Columns in position order with their declared types; one pass, no inference."""
    return spark.read.schema(spec.schema).options(**feed_options(spec, header)).csv(path)
