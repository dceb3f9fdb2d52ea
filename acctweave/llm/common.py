"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has columns of these names already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """True for the documents no model may learn from; null ids are not held out."""
    third = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))
    return F.coalesce(third == 1, F.lit(False))


def share(key: Column, rate: Column | float) -> Column:
    """True for about ``rate`` of the keys, the same ones in every run."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < rate * F.lit(float(1 << 30))
