"""Equi-joins that stay balanced when one key holds a large share of the rows, or of the pairs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_PAIRS = 10_000_000  # pairs that one slice of a key may make
CELL_ROWS = 1_000_000  # rows of both sides that one slice of a key may read
MOST_KEYS = 1_000  # keys that are split at most, those with the most work first


def _grid(left: int, right: int, cell_pairs: int, cell_rows: int) -> tuple[int, int]:
    """Slices of the left and of the right rows of a key.

    Each cell of the grid meets the bounds; among such grids, the one whose sides are cut in
    proportion to their rows repeats the fewest rows.
    """
    cells = max(math.ceil(left * right / cell_pairs), math.ceil((left + right) / cell_rows), 1)
    if not (left and right):
        return (cells, 1) if left else (1, cells)
    across = min(max(round(math.sqrt(cells * left / right)), 1), left, cells)
    return across, min(math.ceil(cells / across), right)


def key_splits(
    left: DataFrame,
    right: DataFrame,
    key: str,
    cell_pairs: int = CELL_PAIRS,
    cell_rows: int = CELL_ROWS,
    most: int = MOST_KEYS,
) -> dict[str, tuple[int, int]]:
    """Slices of the left and right rows for every key with more work than one slice may hold.

    The rows of each key are counted on both sides (combined before the shuffle), as the pairs of a
    key are known from both counts only: a key may be rare on either side and still make most pairs.
    At most ``most`` keys come to the driver; a key that is not among them has less work than each of
    those, so it is no more than 1 / ``most`` of the whole.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))

    both = counted(left, "_nl").join(counted(right, "_nr"), key, "full")
    n_left, n_right = (F.coalesce(c, F.lit(0)).cast("double") for c in ("_nl", "_nr"))
    heavy = (n_left * n_right > cell_pairs) | (n_left + n_right > cell_rows)
    found = (
        both.where(heavy)
        .orderBy(F.desc(n_left * n_right + n_left + n_right), key)
        .limit(most)
        .collect()
    )
    return {r[key]: _grid(r["_nl"] or 0, r["_nr"] or 0, cell_pairs, cell_rows) for r in found}


def _numbers(splits: Column) -> Column:
    """0, 1, ... up to ``splits`` numbers."""
    return F.sequence(F.lit(0).cast("bigint"), splits - 1)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    left_spread: Sequence[str] | None = None,
    cell_pairs: int = CELL_PAIRS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Join on the string column ``key``, inner or left, splitting heavy keys over several tasks.

    The work of a key is its rows and its pairs. A heavy key becomes a grid: its left rows are dealt
    over the rows of the grid by a hash of ``left_spread`` (default: all columns), its right rows over
    the columns, and each is repeated along the other direction, so that every pair meets in one cell
    and the result is that of the plain join. Rows of a left join whose key is null match nothing;
    they go round the join and are not shuffled.

    Finding the heavy keys runs a job over the key column of each side: hand over stored tables.
    Where there are none, this is the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    # found once, so that both sides are dealt by the same splits even if rows are computed again
    splits = key_splits(left, right, key, cell_pairs, cell_rows)
    others = [c for c in right.columns if c != key]
    keyed = left.where(F.col(key).isNotNull())
    joined = _split_join(keyed, right, key, how, left_spread, splits) if splits else keyed.join(right, key, how)
    joined = joined.select(key, *(c for c in left.columns if c != key), *others)
    if how == "inner" or not left.schema[key].nullable:
        return joined
    kinds = {f.name: f.dataType for f in right.schema}
    unmatched = left.where(F.col(key).isNull()).select(
        key,
        *(c for c in left.columns if c != key),
        *(F.lit(None).cast(kinds[c]).alias(c) for c in others),
    )
    return joined.unionAll(unmatched)


def _split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    left_spread: Sequence[str] | None,
    splits: dict[str, tuple[int, int]],
) -> DataFrame:
    hot = F.broadcast(  # at most MOST_KEYS rows
        left.sparkSession.createDataFrame(
            [(k, *n) for k, n in splits.items()], f"`{key}` string, _ls bigint, _rs bigint"
        )
    )
    ls, rs = F.coalesce("_ls", F.lit(1)), F.coalesce("_rs", F.lit(1))
    dealt_left = left.join(hot, key, "left").select(
        *left.columns,
        F.pmod(F.xxhash64(*(left_spread or left.columns)), ls).alias("_l"),
        F.explode(_numbers(rs)).alias("_r"),
        rs.alias("_repeated"),
    )
    dealt_right = right.join(hot, key, "left").select(
        *right.columns,
        F.explode(_numbers(ls)).alias("_l"),
        F.pmod(F.xxhash64(*right.columns), rs).alias("_r"),
        F.lit(True).alias("_met"),
    )
    met = dealt_left.join(dealt_right, [key, "_l", "_r"], how)
    if how == "left":
        # a left row that is repeated has a counterpart in some cell, so those without one are
        # only cells that its counterparts are not dealt to
        met = met.where((F.col("_repeated") == 1) | F.col("_met"))
    return met.drop("_l", "_r", "_repeated", "_met")
