"""Vector code compression: product codes by Lloyd's rounds over members that stay with their owner.

A vector is cut into parts, and every part becomes a member of one entry of its position's codebook.
Members are dealt by (position, entry, salt) and stored there: those groups own them. A round
assigns the members where they lie; owners update an entry from the sums of their resident members,
and only parts whose entry has changed go through the next shuffle, to their new owner. The salt
splits an entry that holds a large share of all parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common
from acctweave.operators.handoff import hand_off
from acctweave.scratch import shared_dir

POSITIONS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components are held within this, so that squared distances fit a long.
BOUND = 1 << 27


@dataclass(frozen=True)
class Compressed:
    """``codes``: the kept columns, ``code`` (entry of each position) and ``error`` of every vector.

    ``codebooks``: int64 array by position, entry and component; ``moved``: the parts that changed
    their entry after each round but the first, which places them all.
    """

    codes: DataFrame
    codebooks: np.ndarray
    moved: tuple[int, ...]

    def digest(self) -> str:
        text = ",".join(map(str, self.codebooks.ravel().tolist()))
        return hashlib.sha256(text.encode()).hexdigest()


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold finite components only."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite


def _integers(vector: Column, width: int) -> Column:
    """floor(SCALE * x) of every component, filled up with zeros to ``width``."""
    scaled = F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND)))).cast("int"),
    )
    return F.concat(scaled, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(vector), F.lit(0))))


def _assigner(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nearest entry and squared distance of every member; of equal ones the lower entry."""
    size = books.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            position = batch.column("position").to_numpy()
            values = batch.column("values").flatten().to_numpy().reshape(n, size).astype(np.int64)
            entry, distance = np.zeros(n, np.int32), np.zeros(n, np.int64)
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                squares = np.zeros((len(at), books.shape[1]), np.int64)
                for j in range(size):
                    squares += (values[at, j, None] - books[p, None, :, j]) ** 2
                entry[at] = squares.argmin(axis=1)
                distance[at] = squares.min(axis=1)
            same = [batch.column(c) for c in ("id", "position", "values", "kept")]
            moved = pa.array(batch.column("entry").to_numpy() != entry)
            found = [pa.array(entry), pa.array(distance), moved]
            yield pa.RecordBatch.from_arrays(
                same + found, ["id", "position", "values", "kept", "entry", "distance", "moved"]
            )

    return assign


def _assigned(members: DataFrame, books: np.ndarray) -> DataFrame:
    kept = members.schema["kept"].dataType.simpleString()
    return members.select("id", "position", "values", "kept", "entry").mapInArrow(
        _assigner(books),
        f"id bigint, position int, values array<int>, kept {kept}, entry int, distance bigint, "
        "moved boolean",
    )


def _at_owners(members: DataFrame, positions: int, name: str) -> DataFrame:
    """``members`` stored by their owners.

    There are as many salts as spread one entry of one position over its share of all partitions.
    """
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, math.ceil(partitions / positions))
    salted = members.select("id", "position", "values", "kept", "entry").withColumn(
        "salt", F.pmod(F.xxhash64("id"), F.lit(salts))
    )
    return hand_off(salted.repartition("position", "entry", "salt"), name)


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry with members as the floor of their mean; the sums are combined in the tasks.

    At most one row per entry comes to the driver, whatever the number of members.
    """
    sums = [F.sum(F.get("values", F.lit(j)).cast("long")).alias(f"s{j}") for j in range(books.shape[2])]
    found = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    out = books.copy()
    for row in found:
        out[row.position, row.entry] = [row[f"s{j}"] // row.n for j in range(books.shape[2])]
    return out


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    keep: Sequence[str] = ("vec_id", "label"),
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Compressed:
    """Codes of all rows of ``vectors`` whose vector is usable, after ``rounds`` of Lloyd's steps.

    The codebooks start from the vectors of the ``entries`` smallest keys (null keys come last, equal
    ones by vector); with fewer rows there are fewer entries. Null vectors, and those with a null or
    non-finite component, give no row. Vectors that are shorter than the longest, or whose length is
    no multiple of ``positions``, are filled up with zeros; scaled components beyond 2**27 count as
    2**27. Repeated rows and repeated keys are rows of their own. Only the columns ``keep`` are
    passed on, under any name. A table without usable rows gives no codes and empty codebooks.
    """
    whole = F.col(f"`{vector}`").cast("array<double>")
    source = vectors.where(usable(whole))
    longest = source.agg(F.max(F.size(whole))).first()[0]
    size = math.ceil((longest or 0) / positions)
    rows = source.select(
        F.monotonically_increasing_id().alias("id"),
        F.col(f"`{key}`").alias("key"),
        _integers(whole, size * positions).alias("values"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
    )
    first = rows.select("key", "values").orderBy(F.asc_nulls_last("key"), "values").limit(entries)
    found = [r["values"] for r in first.collect()]
    start = np.array(found, np.int64).reshape(len(found), positions, size)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))

    cut = F.transform(
        F.sequence(F.lit(0), F.lit(positions - 1)),
        lambda p: F.slice("values", p * size + 1, F.lit(size)),
    )
    parts = rows.select("id", "kept", F.posexplode(cut).alias("position", "values")).select(
        "id",
        "position",
        "values",
        # the other columns travel with the first part only
        F.when(F.col("position") == 0, F.col("kept")).alias("kept"),
        F.lit(-1).alias("entry"),
    )
    if start.shape[0] == 0:
        codes = rows.select("kept.*", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(codes, books, (0,) * max(rounds - 1, 0))

    resident, moved = _at_owners(_assigned(parts, books), positions, "members"), []
    books = _updated(resident, books) if rounds else books
    for _ in range(1, rounds):
        path = shared_dir(vectors.sparkSession, "assigned")
        _assigned(resident, books).drop("distance").write.partitionBy("moved").parquet(path)
        stored = vectors.sparkSession.read.schema(resident.drop("salt").schema.add("moved", "boolean")).parquet(path)
        leaving = _at_owners(stored.where("moved"), positions, "moved")
        moved.append(leaving.count())
        resident = stored.where("NOT moved").drop("moved").unionByName(leaving.drop("salt"))
        books = _updated(resident, books)

    codes = (
        _assigned(resident, books)
        .groupBy("id")
        .agg(
            F.sort_array(F.collect_list(F.struct("position", "entry"))).alias("parts"),
            F.try_sum("distance").alias("error"),
            F.first("kept", ignorenulls=True).alias("kept"),
        )
        .select("kept.*", F.col("parts.entry").alias("code"), "error")
    )
    return Compressed(codes, books, tuple(moved))


def as_hex(code: Column) -> Column:
    """Two lowercase hex digits per entry."""
    return F.array_join(F.transform(code, lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable vector, with the sum of errors over its label."""
    found = compress(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    codes = hand_off(
        found.codes.select("vec_id", "label", as_hex(F.col("code")).alias("code"), "error"), "codes"
    )
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.lit(found.digest()).alias("codebooks_sha256"),
    )


def _nearest(books: str) -> str:
    """Entry and distance of every part under the codebooks ``books``; the data has 64 components."""
    return f"""
    SELECT id, p, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, any_value(d) AS d,
        min(q) % 64 AS e, min(q) // 64 AS distance
    FROM (
        SELECT x.*, ((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)
            + (x.c - y.c) * (x.c - y.c) + (x.d - y.d) * (x.d - y.d)) * 64 + y.e AS q
        FROM parts x JOIN {books} y ON x.p = y.p)
    GROUP BY id, p"""


def _means(books: str, members: str) -> str:
    means = ", ".join(f"coalesce(m.{x}, y.{x}) AS {x}" for x in "abcd")
    sums = ", ".join(f"floor(sum({x}) / count(*))::BIGINT AS {x}" for x in "abcd")
    return f"""
    SELECT y.p, y.e, {means}
    FROM {books} y LEFT JOIN (SELECT p, e, {sums} FROM {members} GROUP BY p, e) m
        ON y.p = m.p AND y.e = m.e"""


SQL = f"""
WITH usable AS (
    SELECT row_number() OVER () AS id, vec_id, label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
    SELECT id, vec_id, p, v[4 * p + 1] AS a, v[4 * p + 2] AS b, v[4 * p + 3] AS c, v[4 * p + 4] AS d
    FROM usable, (SELECT unnest(range(16)) AS p)
),
book0 AS (
    SELECT * FROM (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, a, b, c, d FROM parts)
    WHERE e < 64
),
first AS MATERIALIZED ({_nearest('book0')}),
book1 AS MATERIALIZED ({_means('book0', 'first')}),
second AS MATERIALIZED ({_nearest('book1')}),
book2 AS MATERIALIZED ({_means('book1', 'second')}),
last AS MATERIALIZED ({_nearest('book2')}),
coded AS (
    SELECT id, string_agg(lpad(lower(printf('%x', e)), 2, '0'), '' ORDER BY p) AS code,
        sum(distance)::BIGINT AS error
    FROM last GROUP BY id
),
digest AS (
    SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY p, e))
        AS codebooks_sha256
    FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    codebooks_sha256
FROM coded JOIN usable USING (id), digest
"""
