"""A Bloom filter as a small table: keeps rows out of a shuffle that can't meet their counterpart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18  # of 64 bits: the table never has more rows, whatever it is made from


def _place(key: Column) -> tuple[Column, Column]:
    """Word and bit of a key."""
    h = F.xxhash64(key)
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")
    )
    return F.pmod(h, F.lit(WORDS)), bit


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """``word`` and ``bits`` over all ``key`` values of ``keys``; at most ``WORDS`` rows.

    The distinct comes first, as it lets the optimizer leave out left joins that only add columns to
    ``keys``.
    """
    word, bit = _place(F.col(key))
    places = keys.select(word.alias("word"), bit.alias("bit")).distinct()
    return places.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def sift(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` does not occur in ``keys``.

    None that does occur is lost, and a few others pass: about 6 % of them at a million keys. Where
    the keys are too many for the filter it lets everything through, so the join behind it decides.
    The filter is broadcast: its size is bounded by ``WORDS`` (16 bytes a row), not by ``keys``.
    """
    word, bit = _place(F.col(key))
    found = F.broadcast(sieve(keys, key))
    meets = (word == found["word"]) & (found["bits"].bitwiseAND(bit) != 0)
    return rows.join(found, meets, "left_semi")


def divide(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` is certainly not in ``keys``, and all others."""
    word, bit = _place(F.col(key))
    found = F.broadcast(sieve(keys, key))
    meets = (word == found["word"]) & (found["bits"].bitwiseAND(bit) != 0)
    return rows.join(found, meets, "left_anti"), rows.join(found, meets, "left_semi")
