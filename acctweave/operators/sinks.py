"""Writers for files and tables; all run on the executors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

FORMATS = {
    "CSV": ("csv", {"header": "true"}),
    "TAB": ("csv", {"header": "true", "sep": "\t"}),
    "PARQUET": ("parquet", {}),
    "JSON": ("json", {}),
    "ORC": ("orc", {}),
    "AVRO": ("avro", {}),
}


def write_out(df: DataFrame, path: str, file_type: str = "CSV", mode: str = "overwrite") -> None:
    """Write ``df`` below ``path`` as CSV, TAB, PARQUET, JSON, ORC or AVRO."""
    if file_type not in FORMATS:
        raise ValueError(f"file type must be one of {tuple(FORMATS)}, not {file_type!r}")
    source, options = FORMATS[file_type]
    try:
        df.write.format(source).options(**options).mode(mode).save(path)
    except AnalysisException as e:
        if file_type == "AVRO" and "avro" in str(e).lower() and "deploy" in str(e).lower():
            raise RuntimeError(
                "writing AVRO needs the spark-avro package on the session's class path"
            ) from e
        raise


#: Kept with a table: an overwrite replaces the partitions it brings and leaves the others.
DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def _replace_partitions(df: DataFrame, name: str, path: str | None, partition_by: str) -> None:
    """Write ``df`` over its own partitions of a table, which is created empty where it is missing.

    The first write is an overwrite, too, so that one that is repeated after a failure doubles
    nothing. The mode is an option of the table; the session's settings stay as they are.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        empty = df.limit(0).write.options(**DYNAMIC).partitionBy(partition_by).mode("ignore")
        (empty if path is None else empty.option("path", path)).saveAsTable(name)
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    partition_by: str | None = None,
    buckets: tuple[int, str] | None = None,
    jdbc: dict[str, str] | None = None,
) -> None:
    """Write ``df`` to a table; file paths written elsewhere are never touched.

    ``mode`` is 'append', 'overwrite', or 'overwrite_partitions', which replaces only the values of
    ``partition_by`` found in ``df`` and so can be repeated safely, the first write of a table, which
    must have been created by this mode, included. ``buckets`` (count, column)
    keeps the table hashed on a column so that later joins on it need no shuffle. With ``jdbc``
    (``url`` and driver properties) every partition writes to the database itself.
    """
    if mode not in ("append", "overwrite", "overwrite_partitions"):
        raise ValueError(f"unknown table mode {mode!r}")
    if jdbc is not None:
        if mode == "overwrite_partitions":
            raise ValueError("a database table can be overwritten or appended to")
        df.write.format("jdbc").options(dbtable=name, **jdbc).mode(mode).save()
        return
    if mode == "overwrite_partitions":
        if partition_by is None:
            raise ValueError("overwrite_partitions needs partition_by")
        _replace_partitions(df, name, path, partition_by)
        return
    writer = df.write.mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if buckets is not None:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    writer.saveAsTable(name)
