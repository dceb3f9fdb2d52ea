"""Delimited files read without losing anything: every line becomes a row or a reject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.sources.delimited import feed_options
from acctweave.specs import FeedSpec

#: Columns beside those of the spec: the file, the reason (null for sound rows) and the line (then
#: null, too). Names of a feed must not clash with them.
FILE, REASON, LINE = "LANDED_FILE", "REJECT_REASON", "REJECT_LINE"
RAW = "_raw"


def line_options(spec: FeedSpec) -> dict[str, str]:
    """Reader options that give whole lines, decoded as the spec says, in one column ``line``."""
    return {
        "sep": "\x01",
        "quote": "",
        "encoding": spec.encoding,
        "header": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
    }


LINE_SCHEMA = f"line string, {RAW} string"


def _lines(read: DataFrame) -> DataFrame:
    return read.select(
        F.coalesce(RAW, "line").alias(LINE), F.col("_metadata.file_name").alias(FILE)
    )


def feed_lines(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """The lines of the files in ``path`` that are not blank, each with the name of its file."""
    return _lines(spark.read.schema(LINE_SCHEMA).options(**line_options(spec)).csv(path))


def _parser_options(spec: FeedSpec) -> dict[str, str]:
    return {
        "sep": spec.delimiter,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
    }


def _schema(spec: FeedSpec) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in spec.inputs), f"{RAW} string"])


def _open_quote(line: Column) -> Column:
    plain = F.replace(line, F.lit('\\"'), F.lit(""))
    return (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2 == 1


def _reason(line: Column, spec: FeedSpec) -> Column:
    """Why a line that the parser refuses is refused."""
    outside = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")
    sep = F.lit(spec.delimiter)
    n = (F.length(outside) - F.length(F.replace(outside, sep, F.lit("")))) / len(spec.delimiter) + 1
    return (
        F.when(n < len(spec.inputs), "short").when(n > len(spec.inputs), "surplus").otherwise("value")
    )


def _with_headers(rows: DataFrame, is_header: Column, checked: bool) -> DataFrame:
    """``rows`` without header lines; those of files that have none are rejected."""
    if not checked:
        return rows
    marked = rows.withColumn("_header", F.coalesce(is_header, F.lit(False)))
    files = marked.groupBy(FILE).agg(F.max("_header").alias("_good"))
    reason = F.when(~F.col("_good"), F.lit("header")).otherwise(F.col(REASON))
    return (
        marked.where("NOT _header")
        .join(files, FILE)
        .withColumn(REASON, reason)
        .drop("_header", "_good")
    )


def check_lines(lines: DataFrame, spec: FeedSpec, header: bool | None = None) -> DataFrame:
    """``lines`` as columns of the spec, with ``FILE``, ``REASON`` and ``LINE``.

    ========  ===========================================================
    reason    the line
    ========  ===========================================================
    header    belongs to a file without the header line that is expected
    quotes    opens a quote that it does not close
    short     has fewer fields than the spec
    surplus   has more
    value     holds a value that is not of the declared type
    ========  ===========================================================

    Rejects keep the whole line, and the fields that could be read. Header lines are no rows.
    """
    has_header = spec.has_header if header is None else header
    names = [name for name, _ in spec.inputs]
    parsed = lines.withColumn("_p", F.from_csv(LINE, _schema(spec), _parser_options(spec)))
    reason = F.when(_open_quote(F.col(LINE)), "quotes").when(
        F.col(f"_p.{RAW}").isNotNull(), _reason(F.col(LINE), spec)
    )
    marks = F.regexp_replace(LINE, '"', "") == spec.delimiter.join(names)
    rows = _with_headers(parsed.withColumn(REASON, reason), marks, has_header)
    return rows.select(
        *(F.col(f"_p.`{n}`").alias(n) for n in names),
        FILE,
        REASON,
        F.when(F.col(REASON).isNotNull(), F.col(LINE)).alias(LINE),
    )


def scan_checked(
    spark: SparkSession,
    path: str,
    spec: FeedSpec,
    header: bool | None = None,
    multiline: bool = False,
) -> DataFrame:
    """As ``scan_feed``, with every line that is no record of the spec as a reject (``check_lines``).

    A wrong header rejects its file and not the scan. Records may not span lines, whose pieces are
    rejects then, unless ``multiline`` is set; each file is then read by one task, and an unclosed
    quote takes in what follows it. Split the result by ``sound_rows`` and ``scan_rejects``.
    """
    if not multiline:
        return check_lines(feed_lines(spark, path, spec), spec, header)
    has_header = spec.has_header if header is None else header
    options = feed_options(spec, False) | _parser_options(spec) | {"multiLine": "true"}
    names = [name for name, _ in spec.inputs]
    read = spark.read.schema(_schema(spec)).options(**options).csv(path)
    reason = F.when(F.col(RAW).isNotNull(), _reason(F.trim(RAW, F.lit("\r\n")), spec))
    rows = read.select("*", F.col("_metadata.file_name").alias(FILE), reason.alias(REASON))
    values = (F.col(n).cast("string").eqNullSafe(F.lit(n)) for n in names)
    typed = F.trim(RAW, F.lit("\r\n")) == spec.delimiter.join(names)
    rows = _with_headers(rows, reduce(lambda a, b: a & b, values) | F.coalesce(typed, F.lit(False)), has_header)
    line = F.coalesce(RAW, F.concat_ws(spec.delimiter, *(F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names)))
    return rows.select(
        *names, FILE, REASON, F.when(F.col(REASON).isNotNull(), line).alias(LINE)
    )


def sound_rows(checked: DataFrame) -> DataFrame:
    """The rows of a checked scan, in the layout of ``scan_feed``."""
    return checked.where(F.col(REASON).isNull()).drop(FILE, REASON, LINE)


def scan_rejects(checked: DataFrame) -> DataFrame:
    """The rejects of a checked scan: file, reason, line."""
    return checked.where(F.col(REASON).isNotNull()).select(FILE, REASON, LINE)
