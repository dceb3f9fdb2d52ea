"""Near-duplicate embeddings: collisions of one-dimensional projections are counted, pairs verified.

Unit vectors are projected on ``TABLES * DEPTH`` random lines. Two vectors collide on a line if
one lies in the window centred at the other. A pair is a candidate if it collides on at least as
many lines as ``RECALL`` of all pairs at the least cosine do (binomial tail), and is linked if its
exact cosine in double precision suffices.

Counting over all pairs of a label would grow with their square. So vectors meet only where they
share a cell of one of ``TABLES`` grids, each of ``DEPTH`` of the lines; a pair is counted in the
first grid where it shares one. In a cell the projections are sorted line by line, and windows are
ranges of ranks. After ``FIRST`` lines most pairs fall short of what pairs at the least cosine reach
there; the others are counted on all lines as a list. Large cells are cut into blocks, and pairs of blocks are separate tasks; nothing
is capped. Tasks return sums of links and a spanning forest of them, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common
from acctweave.llm.components import components
from acctweave.operators.handoff import hand_off

COSINE = 0.98
TABLES, DEPTH = 24, 8
CELL = 5.0  # side of a cell, in distances of vectors at the least cosine
HALF_WINDOW = 1.5  # in the same distances
RECALL = 0.9995  # of the count, per pair at the least cosine
FIRST, FIRST_RECALL = 16, 0.99995  # lines that all pairs of a cell are counted on, and their recall
PAIRS = 20_000  # pairs that are counted on all lines at once
BLOCK = 1_500  # vectors of a cell that meet at once
SEED = 11


def least_collisions(lines: int, half_window: float = HALF_WINDOW, recall: float = RECALL) -> int:
    """The count that pairs at the least cosine reach with probability ``recall``.

    On a line of normal entries the difference of such a pair is normal with the distance as its
    standard deviation, so it lies in the window with probability erf(half_window / sqrt 2).
    """
    p = math.erf(half_window / math.sqrt(2))
    tail = 0.0
    for k in range(lines, 0, -1):
        tail += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if tail >= recall:
            return k
    return 0


@cache
def _lines(dim: int, tables: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.normal(size=(dim, tables * depth)), rng.random(tables * depth)


def _unit(rows: pa.Array, dim: int) -> np.ndarray:
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(h: np.ndarray, shift: np.ndarray, side: float, tables: int) -> np.ndarray:
    """n x tables: one number for the cell of each grid."""
    at = np.floor(h / side + shift).astype(np.int64).astype(np.uint64).reshape(len(h), tables, -1)
    out = np.broadcast_to(np.arange(tables, dtype=np.uint64), at.shape[:2]).copy()
    for k in range(at.shape[2]):
        out = (out ^ at[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def link_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, depth: int = DEPTH, block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links`` and ``component_id`` of every row of ``vectors``.

    Rows (``vec_id``, ``embedding``, ``label``) are linked if their labels are equal and not null
    and their cosine is ``cosine`` or more. Vectors that are null, empty, zero or hold null or
    non-finite numbers, rows without an id, and vectors of different lengths are not linked;
    unlinked rows have 0 links and their own id as the component. Equal vectors are one until the
    end and count as often as they occur. Rows that repeat an id have the links of their own vectors.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    )
    good = rows.where(F.coalesce(usable, F.lit(False)))
    groups = hand_off(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    ).withColumns(
        {
            "dim": F.size("embedding"),
            # a number of its own for each distinct vector of a label, as ids may repeat
            "node": F.shiftrightunsigned(F.xxhash64("label", "embedding"), 1),
        }
    )
    far = math.sqrt(2 - 2 * cosine)
    side, half = CELL * far, HALF_WINDOW * far
    needed = least_collisions(tables * depth)
    first = min(FIRST, tables * depth)
    soon = least_collisions(first, recall=FIRST_RECALL)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, dims = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == dim))
                lines, shift = _lines(int(dim), tables, depth)
                cells = _cells(_unit(batch.column(1).take(at), int(dim)) @ lines, shift, side, tables)
                yield pa.RecordBatch.from_arrays(
                    [
                        node.take(pa.array(np.repeat(at.to_numpy(), tables))),
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))),
                        pa.array(cells.ravel()),
                    ],
                    ["node", "grid", "cell"],
                )

    cells = groups.select("node", "embedding", "dim").mapInArrow(keys, "node bigint, grid int, cell bigint")
    placed = cells.join(groups.select("node", "label", "dim", "copies"), "node")
    met = hand_off(placed, "cells")
    where = ["label", "dim", "grid", "cell"]
    crowds = met.groupBy(*where).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # blocks of a cell, and every pair of blocks as a task of its own
    blocks = met.join(crowds, where).withColumn("of", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("of")).cast("int")
    )
    tasks = blocks.select(
        *where,
        "node",
        "own",
        "copies",
        F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("other"),
    ).select(
        F.xxhash64(*where, F.least("own", "other"), F.greatest("own", "other")).alias("task"),
        "grid",
        "node",
        "copies",
        "own",
        (F.col("own") != F.col("other")).alias("two"),
    )
    dealt = tasks.join(groups.select("node", "embedding", "dim"), "node").select(
        "task", "grid", "node", "copies", "own", "two", "dim", "embedding"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            task = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(task)) + 1
            limits = [0, *edges.tolist(), len(task)]
            for a, b in zip(limits[:-1], limits[1:], strict=True):
                piece = batch.slice(a, b - a)
                if held and held[0].column(0)[0].as_py() != task[a]:
                    yield from _count(held)
                    held = []
                if b > a:
                    held.append(piece)
        if held:
            yield from _count(held)

    def _count(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        dim, grid = rows["dim"][0].as_py(), rows["grid"][0].as_py()
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        own, two = rows["own"].to_numpy(), rows["two"][0].as_py()
        if len(node) < 2:
            return
        x = _unit(rows["embedding"].combine_chunks() if rows["embedding"].num_chunks != 1 else rows["embedding"].chunk(0), dim)
        lines, shift = _lines(dim, tables, depth)
        h = x @ lines
        n = len(x)
        hits = np.zeros((n, n), np.int16)
        for line in h.T[:first]:  # windows as ranges of ranks in the sorted line
            order = np.argsort(line, kind="stable")
            rank = np.empty(n, np.int32)
            rank[order] = np.arange(n, dtype=np.int32)
            low = np.searchsorted(line[order], line - half, side="left").astype(np.int32)
            high = np.searchsorted(line[order], line + half, side="right").astype(np.int32)
            hits += (rank >= low[:, None]) & (rank < high[:, None])
        near = np.triu(np.maximum(hits, hits.T) >= soon, 1)
        if two:
            near &= own[:, None] != own
        i, j = np.nonzero(near)
        at = _cells(h, shift, side, tables)
        kept = [(i[:0], j[:0])]
        for k in range(0, len(i), PAIRS):
            a, b = i[k : k + PAIRS], j[k : k + PAIRS]
            if grid:  # counted in an earlier grid already
                new = ~(at[a, :grid] == at[b, :grid]).any(axis=1)
                a, b = a[new], b[new]
            enough = (np.abs(h[a] - h[b]) <= half).sum(axis=1) >= needed
            a, b = a[enough], b[enough]
            ok = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
            kept.append((a[ok], b[ok]))
        i, j = (np.concatenate(z) for z in zip(*kept, strict=True))
        links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        up = np.arange(n)
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            while up[a] != a:
                up[a] = a = up[up[a]]
            while up[b] != b:
                up[b] = b = up[up[b]]
            up[max(a, b)] = min(a, b)
        some = np.flatnonzero(links)
        for k in range(n):
            up[k] = up[up[k]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(node[up[some]])],
            ["node", "links", "to"],
        )

    found = hand_off(
        dealt.repartition("task").sortWithinPartitions("task").mapInArrow(count, "node bigint, links bigint, to bigint"),
        "found",
    )
    joined = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_group = (
        groups.join(sums, "node", "left")
        .join(joined, "node", "left")
        .select(
            "label",
            "embedding",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    names = by_group.groupBy("component").agg(F.min("least").alias("name"))
    by_group = by_group.join(names, "component").select(
        "label", "embedding", "links", F.col("name").alias("component")
    )
    linked = good.join(by_group, ["label", "embedding"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id")
    )
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` with its links and its component."""
    return link_vectors(common.table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
