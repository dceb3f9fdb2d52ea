"""Substring dedup: repeated windows of words are found by Rabin-Karp hashes and removed.

Every window of ``WINDOW`` consecutive words is hashed. A window is repeated if its hash also
starts in a document with a smaller id; the repeated windows of a document merge into maximal
intervals of words, which go.

Windows that no other text can share are left out before they are counted, without loss: any
stretch of ``WINDOW`` words contains a kept hash of ``GRAM`` words (``rolling.winnowed``), so both
texts of a shared window hold one. Only windows around a gram that two different texts hold are
counted. Copies of a whole text are found by a digest of the text and need no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common, rolling
from acctweave.operators.handoff import hand_off

WINDOW = 50
GRAM = 16
LAST = (1 << 63) - 1  # stands for a null id: after all others

_SUMMARY = "n_words bigint, whole_sha256 string, grams array<bigint>"
_WINDOWS = "starts array<int>, h1 array<bigint>, h2 array<int>"
_CUT = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept string"


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    places = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=places[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(flat, kind))


def _values(rows: pa.Array) -> Iterator[np.ndarray]:
    if len(rows):
        flat, places = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
        for a, b in zip(places[:-1], places[1:], strict=True):
            yield flat[a:b]


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at ASCII white space only


def _summary(window: int, gram: int):
    def summary(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, whole, grams = [], [], []
            for start, stop in rolling.chunks(texts):
                part = texts.slice(start, stop - start)
                words, text = rolling.word_hashes(part)
                hashes = rolling.gram_hashes(words, gram)
                kept = np.flatnonzero(rolling.winnowed(hashes, text, gram, window - gram + 1))
                limits = np.searchsorted(text[kept], np.arange(len(part) + 1))
                found = hashes[kept].view(np.int64)
                for i, t in enumerate(part.to_pylist()):
                    split = _split(t)
                    n.append(len(split))
                    whole.append(hashlib.sha256(b" ".join(split)).hexdigest())
                    grams.append(np.unique(found[limits[i] : limits[i + 1]]))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(whole, pa.string()), _lists(grams, pa.int64())],
                ["n_words", "whole_sha256", "grams"],
            )

    return F.arrow_udf(summary, _SUMMARY)


def _windows(window: int, gram: int):
    def windows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, shared in batches:
            out = [], [], []
            for i, held in enumerate(_values(shared)):
                words, _ = rolling.word_hashes(texts.slice(i, 1))
                hit = np.isin(rolling.gram_hashes(words, gram).view(np.int64), held)
                near = np.zeros(max(0, len(words) - window + 1), bool)
                if len(near):  # windows that hold a hit: starts up to window - gram before it
                    sums = np.concatenate([[0], np.cumsum(hit)])
                    near = sums[window - gram + 1 :] - sums[: len(sums) - (window - gram + 1)] > 0
                starts = np.flatnonzero(near)
                out[0].append(starts.astype(np.int32))
                for held_in, base, kind in ((out[1], rolling.BASE, np.int64), (out[2], rolling.OTHER_BASE, np.int32)):
                    h = rolling.mix(rolling.run_hashes(words, starts, starts + window, base))
                    held_in.append(h.view(np.int64) if kind is np.int64 else (h >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.StructArray.from_arrays(
                [_lists(out[0], pa.int32()), _lists(out[1], pa.int64()), _lists(out[2], pa.int32())],
                ["starts", "h1", "h2"],
            )

    return F.arrow_udf(windows, _WINDOWS)


def _cut(window: int):
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, repeated in batches:
            n, spans, kept = [], [], []
            for t, starts in zip(texts.to_pylist(), _values(repeated), strict=True):
                split = _split(t)
                depth = np.zeros(len(split) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, starts + window, -1)
                gone = np.cumsum(depth)[:-1] > 0
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                n.append(len(split))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                kept.append(b" ".join([w for w, g in zip(split, gone, strict=True) if not g]).decode())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string())],
                ["n_words", "spans", "kept"],
            )

    return F.arrow_udf(cut, _CUT)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"),
        F.xxhash64("text").alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """All documents in short, and those that lose words.

    The first table has ``key``, ``tag``, ``n_words`` and ``whole_sha256`` (of the words joined by
    one space) of every row of ``docs`` (``doc_id``, ``text``); the second, ``key``, ``tag``,
    ``n_words``, ``spans`` (maximal intervals of words to remove) and ``kept`` (the words left,
    joined by one space), once for each of its documents. ``key`` is the id and ``tag`` a hash of
    the text, which tells apart rows that repeat an id.

    Null and empty texts have no words. Documents of fewer than ``window`` words lose none. A null
    id counts as larger than all others. Rows of the same id never remove each other's words.
    """
    keyed = _keyed(docs)
    brief = hand_off(
        keyed.select("key", "tag", F.unhex(F.md5("text")).alias("copy"), _summary(window, gram)("text").alias("s")).select(
            "key", "tag", "copy", "s.*"
        ),
        "grams",
    )
    # copies of a whole text: all but the first lose every word
    long_enough = brief.where(F.col("n_words") >= window)
    firsts = long_enough.groupBy("copy").agg(F.min("key").alias("first"))
    marked = long_enough.select("key", "tag", "copy", "n_words").join(firsts, "copy")
    whole = (
        marked.where(F.col("first") < F.col("key"))
        .select(
            "key",
            "tag",
            "n_words",
            F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))).alias("spans"),
            F.lit("").alias("kept"),
        )
        .distinct()
    )
    # grams that two different texts hold, and for each first copy those that it holds
    grams = brief.select("key", "tag", F.explode("grams").alias("gram"))
    shared = (
        grams.groupBy("gram")
        .agg(F.min("tag").alias("a"), F.max("tag").alias("b"))
        .where(F.col("a") != F.col("b"))
        .select("gram")
    )
    held = grams.join(shared, "gram").groupBy("key", "tag").agg(F.collect_set("gram").alias("grams"))
    first_copies = marked.where(F.col("first") == F.col("key")).select("key", "tag").distinct()
    windows = hand_off(
        keyed.join(held.join(first_copies, ["key", "tag"]), ["key", "tag"])
        .select("key", "tag", "text", _windows(window, gram)("text", "grams").alias("w"))
        .select("key", "tag", "text", "w.*"),
        "windows",
    )
    each = windows.select("key", "tag", F.inline(F.arrays_zip("starts", "h1", "h2")))
    repeated = (
        each.groupBy("h1", "h2")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .where(F.col("first") < F.col("last"))
    )
    starts = (
        each.join(repeated, ["h1", "h2"])
        .where(F.col("first") < F.col("key"))
        .groupBy("key", "tag")
        .agg(F.collect_set("starts").alias("starts"))
    )
    parts = (
        windows.select("key", "tag", "text")
        .join(starts, ["key", "tag"])
        .select("key", "tag", _cut(window)("text", "starts").alias("c"))
        .select("key", "tag", "c.*")
    )
    return brief.select("key", "tag", "n_words", "whole_sha256"), whole.unionByName(parts)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; other rows and columns unchanged.

    A text that loses words becomes the words left, joined by one space. Rows stay, also if
    nothing is left of their text.
    """
    key, tag, kept = common.fresh(docs, "_key", "_tag", "_kept")
    _, changed = find_repeats(docs, window)
    changed = changed.dropDuplicates(["key", "tag"]).select(
        F.col("key").alias(key), F.col("tag").alias(tag), F.col("kept").alias(kept)
    )
    keyed = docs.withColumns(
        {key: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), tag: F.xxhash64("text")}
    )
    text = F.coalesce(kept, "text").alias("text")
    return keyed.join(changed, [key, tag], "left").select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with the number of words removed and a digest of the rest."""
    brief, changed = find_repeats(common.table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    changed = changed.select("key", "tag", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
    return brief.join(changed.dropDuplicates(["key", "tag"]), ["key", "tag"], "left").select(
        F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


#: The definition, window by window; for tables of unique, non-null ids.
SQL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, sha256(list_aggregate(w[i:i + 49], 'string_agg', ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM windows JOIN firsts USING (h) WHERE first < doc_id
),
lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
    sha256(coalesce(list_aggregate(CASE WHEN ps IS NULL THEN w
        ELSE list_select(w, list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(ps, x))) END,
        'string_agg', ' '), '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
"""
