"""Vector codes against a plain Lloyd's loop, on ties, repeated rows, bad vectors and empty tables."""

import hashlib
import math
import random

import numpy as np
import pytest

from acctweave.llm import vector_codes as vc

ROWS = "vec_id bigint, embedding array<double>, label int, entry string, id int, position int"


def lloyd(vectors, positions, entries, rounds):
    """Codes, errors and codebooks by whole passes; ``vectors`` are integer lists in key order."""
    x = np.array(vectors, dtype=object).reshape(len(vectors), positions, -1)
    books = [[list(map(int, x[e, p])) for e in range(min(entries, len(x)))] for p in range(positions)]

    def assign():
        out = []
        for v in x:
            row = []
            for p in range(positions):
                d = [sum((int(a) - b) ** 2 for a, b in zip(v[p], c, strict=True)) for c in books[p]]
                row.append((d.index(min(d)), min(d)))
            out.append(row)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(positions):
            for e in range(len(books[p])):
                mine = [x[i, p] for i, row in enumerate(found) if row[p][0] == e]
                if mine:
                    books[p][e] = [sum(map(int, c)) // len(mine) for c in zip(*mine, strict=True)]
    return assign(), books


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_codes_equal_whole_passes(spark, rounds):
    rng = random.Random(rounds)
    vectors = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(150)]
    vectors += [vectors[3]] * 40  # a hot entry of copies
    rows = [(i, v, i % 3, "e", 1, 2) for i, v in enumerate(vectors)]
    found = vc.compress(spark.createDataFrame(rows, ROWS), positions=4, entries=8, rounds=rounds)
    want, books = lloyd([[math.floor(256 * c) for c in v] for v in vectors], 4, 8, rounds)
    assert found.codebooks.tolist() == books
    got = {r.vec_id: (r.code, r.error) for r in found.codes.collect()}
    for i, row in enumerate(want):
        assert got[i] == ([e for e, _ in row], sum(d for _, d in row))
    assert len(found.moved) == rounds - 1 and all(m < len(vectors) * 4 for m in found.moved)


def test_unusable_vectors_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0, 0.0, 1.0], None, "e", 1, 2),
        (1, [0.0, 1.0, 0.0, 1.0], None, "e", 1, 2),  # a repeated row: a tie goes to the lower entry
        (2, None, 1, "e", 1, 2),
        (3, [1.0, None, 0.0, 0.0], 1, "e", 1, 2),
        (4, [nan, 0.0, 0.0, 0.0], 1, "e", 1, 2),
        (5, [inf, 0.0, 0.0, 0.0], 1, "e", 1, 2),
        (None, [9.0, -9.001], 7, "e", 1, 2),  # shorter: filled up with zeros
        (6, [], 7, "e", 1, 2),
        (7, [1e30, 0.0, 0.0, 0.0], 7, "e", 1, 2),  # held within the bound
    ]
    found = vc.compress(spark.createDataFrame(rows, ROWS), positions=2, entries=3, rounds=2)
    # in the order of the keys, null last
    whole = [[0, 256, 0, 256]] * 2 + [[0] * 4, [vc.BOUND, 0, 0, 0], [2304, -2305, 0, 0]]
    want, books = lloyd(whole, 2, 3, 2)
    codes = sorted(((r.vec_id, r.code, r.error) for r in found.codes.collect()), key=repr)
    keys = [1, 1, 6, 7, None]
    expected = [(k, [e for e, _ in row], sum(d for _, d in row)) for k, row in zip(keys, want, strict=True)]
    assert codes == sorted(expected, key=repr)
    assert found.codebooks.tolist() == books


def test_empty_table_and_empty_vectors(spark):
    empty = spark.createDataFrame([], ROWS)
    found = vc.compress(empty)
    assert found.codes.count() == 0 and found.digest() == hashlib.sha256(b"").hexdigest()
    hollow = vc.compress(spark.createDataFrame([(1, [], 1, "e", 1, 2)], ROWS), positions=2)
    assert [(r.code, r.error) for r in hollow.codes.collect()] == [([0, 0], 0)]
