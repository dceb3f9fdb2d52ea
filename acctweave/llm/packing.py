"""Mixture-controlled packing: deficit round-robin over one queue of token ids for each source.

In every round a source's credit grows by its share of a window. It spends the credit in steps of
``QUANTUM`` ids from the head of its queue and carries the rest, its deficit, to the next round.
The ids served, in the order of round, source and queue, fill one sequence after the other without
gaps. So each stretch of windows holds each source's share to within one quantum, and only the
last sequence is not full.

How far a source has got by the end of a round follows from its share alone, so the rounds need no
sequential pass: every task computes the rounds of its own documents, and windows in Spark turn
lengths into places (running sums over blocks of documents, then over blocks of rounds).
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from acctweave.llm import common, rolling
from acctweave.llm.chunk_cache import ChunkCache
from acctweave.scratch import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 1  # the id that closes a document
LENGTH = 2_048  # ids of a sequence
QUANTUM = 128  # ids that a source serves at a time
SPACE = "Ġ"  # how the vocabulary writes a leading space
TOGETHER = 128  # chunks encoded as one text
NO_SOURCE = "\x00"  # the queue of documents without a source

_WORD = re.compile(r" \S(?:[^ ]*\S)?")
_LETTERS = re.compile(r" [A-Za-zÀ-ÖØ-öø-ɏ]+")
#: The bytes beyond ASCII letters that the byte-level vocabulary writes as others, behind U+0100 in their order.
_BYTES = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_WRITTEN = [(chr(b), chr(0x100 + k)) for k, b in enumerate(_BYTES) if b > 127]


@cache
def _tokenizer(path: str, end: int) -> ChunkCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    tokenizer = Tokenizer.from_file(path)
    setup = json.loads(tokenizer.to_str())
    split = setup["pre_tokenizer"] or {}
    # letters are a piece of their own, and no text is changed or taken out before it is split
    plain = (
        split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and setup["normalizer"] is None
        and all(t["content"].startswith("<") and not t["normalized"] for t in setup["added_tokens"])
    )
    ready = Tokenizer.from_file(path)  # for words as the vocabulary writes them
    ready.pre_tokenizer = WhitespaceSplit()

    opens = np.zeros(tokenizer.get_vocab_size(), bool)  # ids of tokens that begin with a space
    opens[[i for t, i in tokenizer.get_vocab().items() if t.startswith(SPACE)]] = True

    def each(texts: list[str], by: Tokenizer = tokenizer) -> list[np.ndarray]:
        found = by.encode_batch_fast(texts, add_special_tokens=False)  # without offsets
        return [np.array(x.ids, "<u4") for x in found]

    def words(text: str) -> str:
        if not text.isascii():
            text = text.encode().decode("latin-1")
            for byte, mark in _WRITTEN:
                text = text.replace(byte, mark)
        return text.replace(" ", f" {SPACE}")

    def encode(chunks: list[str]) -> list[bytes]:
        # chunks with no space but the one in front are encoded as one text and told apart by it
        letters, others = [], []
        for k, c in enumerate(chunks):
            if plain and _LETTERS.fullmatch(c):
                letters.append(k)
            elif _WORD.fullmatch(c):
                others.append(k)
        groups = [x[k : k + TOGETHER] for x in (letters, others) for k in range(0, len(x), TOGETHER)]
        texts = ["".join(chunks[k] for k in g) for g in groups]
        n = math.ceil(len(letters) / TOGETHER)
        out: list[bytes | None] = [None] * len(chunks)
        for group, ids in zip(groups, each([words(t) for t in texts[:n]], ready) + each(texts[n:]), strict=True):
            starts = np.flatnonzero(opens[ids])
            if len(starts) == len(group):  # always, with a vocabulary of single leading spaces
                raw, places = ids.tobytes(), [*(starts * 4).tolist(), len(ids) * 4]
                for k, a, b in zip(group, places[:-1], places[1:], strict=True):
                    out[k] = raw[a:b]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, each([chunks[k] for k in rest]), strict=True):
            out[k] = ids.tobytes()
        return out

    return ChunkCache(encode, cores=plain)


def tokens(docs: DataFrame, path: str = TOKENIZER, end: int = END) -> DataFrame:
    """``doc_id``, ``source`` and ``ids`` of whole texts and ``end``, unsigned little-endian 32 bits."""
    kept = docs.select("doc_id", "source", "text")
    fields = [*kept.schema.fields[:2], StructField("ids", BinaryType())]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = _tokenizer(path, end), struct.pack("<I", end)
        for batch in batches:
            for start, stop in rolling.chunks(batch.column(2)):  # small batches go on at once
                part = batch.slice(start, stop - start)
                rows = [b + last for b in known.texts([t or "" for t in part.column(2).to_pylist()])]
                columns = [part.column(0), part.column(1), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "ids"])

    return kept.mapInArrow(encoded, StructType(fields))


def _running(df: DataFrame, blocks: DataFrame, by: list[str], block: str, order: list[str], size: str, name: str) -> DataFrame:
    """``name``: the sum of ``size`` over all earlier rows, within ``by``.

    Rows are ordered by ``block`` first; a block is summed in one task, and so are the sums of the
    blocks, so the number of blocks should be about the root of the number of rows.
    """
    before = Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    return (
        df.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(starts, [*by, block])
        .withColumn(name, F.col("_base") + F.col("_in"))
        .drop("_base", "_in")
    )


def pack(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    path: str = TOKENIZER,
    end: int = END,
) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``, ``source``) in sequences of ``length`` ids.

    ``weights`` are the target shares of the sources, over all ids by default, and must be above 0; a
    source without a weight gets that of the smallest named one. A queue holds the documents of its source in
    the order of a hash of their number in the stored table of ids. When a queue has ended, the others share its part.

    Null and empty texts are a document of the one id ``end``. A null source is a queue of its
    own, a null id a document like any other. Repeated rows are packed once each. An empty table
    gives no pieces. Returns one row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset``, ``ids`` (binary, as in ``tokens``).
    """
    if weights and not all(w > 0 for w in weights.values()):
        raise ValueError("every weight must be above 0; leave out the documents of a source instead")
    spark = docs.sparkSession
    stored = shared_dir(spark, "tokens")
    (
        tokens(docs, path, end)
        .withColumn("source", F.coalesce("source", F.lit(NO_SOURCE)))
        .withColumn("doc_tokens", (F.length("ids") / 4).cast("long"))
        .withColumn("row", F.monotonically_increasing_id())
        .write.option("compression", "zstd")
        .parquet(stored)
    )
    whole = spark.read.parquet(stored)
    rows = whole.select("row", "doc_id", "source", "doc_tokens")

    # the queues: a source's documents in blocks by hash, as many as the root of their number
    totals = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_n"), F.sum("doc_tokens").alias("_t"))
    everything = rows.agg(F.sum("doc_tokens")).first()[0] or 1
    share = F.col("_t") / everything
    if weights:
        least, total = min(weights.values()), sum(weights.values())
        share = F.lit(least / total)
        for source, weight in weights.items():
            share = F.when(F.col("source") == source, weight / total).otherwise(share)
    width = math.ceil(math.sqrt(everything / length))  # rounds of a block
    queues = totals.select(
        "source",
        F.ceil(F.sqrt("_n")).alias("_blocks"),
        share.alias("_share"),
    )
    dealt = rows.join(queues, "source").withColumn(
        "_block", F.floor(F.shiftrightunsigned(F.xxhash64("row"), 34) * F.col("_blocks") / (1 << 30))
    )
    sums = dealt.groupBy("source", "_block").agg(F.sum("doc_tokens").alias("_sum"))
    queued = _running(dealt, sums, ["source"], "_block", ["row"], "doc_tokens", "_from")

    # what a source serves at a time, and the round in which its credit suffices
    steps = queued.select(
        "row",
        "source",
        "_from",
        "doc_tokens",
        "_share",
        F.explode(
            F.sequence(F.floor(F.col("_from") / quantum), F.floor((F.col("_from") + F.col("doc_tokens") - 1) / quantum))
        ).alias("_step"),
    ).select(
        "row",
        "source",
        F.ceil((F.col("_step") + 1) * quantum / (F.col("_share") * length)).alias("_round"),
        F.greatest(F.col("_step") * quantum, "_from").alias("_at"),
        (F.least((F.col("_step") + 1) * quantum, F.col("_from") + F.col("doc_tokens"))).alias("_to"),
        "_from",
    )
    served = steps.select(
        "row",
        "source",
        "_round",
        "_at",
        (F.col("_at") - F.col("_from")).alias("start"),
        (F.col("_to") - F.col("_at")).alias("length"),
        F.floor(F.col("_round") / width).alias("_block"),
    )
    sums = served.groupBy("_block").agg(F.sum("length").alias("_sum"))
    placed = _running(served, sums, [], "_block", ["_round", "source", "_at"], "length", "_place")

    # a piece that meets the end of a sequence goes on in the next one
    cut = (
        placed.withColumn(
            "sequence_id",
            F.explode(F.sequence(F.floor(F.col("_place") / length), F.floor((F.col("_place") + F.col("length") - 1) / length))),
        )
        .withColumn("_a", F.greatest(F.col("_place"), F.col("sequence_id") * length))
        .withColumn("_b", F.least(F.col("_place") + F.col("length"), (F.col("sequence_id") + 1) * length))
        .select(
            "row",
            F.struct(
                (F.col("start") + F.col("_a") - F.col("_place")).alias("start"),
                (F.col("_b") - F.col("_a")).alias("length"),
                "sequence_id",
                (F.col("_a") - F.col("sequence_id") * length).alias("offset"),
            ).alias("piece"),
        )
    )
    # all pieces of a document meet its ids once; there are as many as the document is long
    by_doc = cut.groupBy("row").agg(F.collect_list("piece").alias("pieces"))
    return (
        whole.join(by_doc, "row")
        .select(
            "doc_id",
            "doc_tokens",
            F.inline(
                F.transform(
                    "pieces",
                    lambda p: F.struct(
                        p["start"].alias("start"),
                        p["length"].alias("length"),
                        p["sequence_id"].alias("sequence_id"),
                        p["offset"].alias("offset"),
                        F.substring("ids", p["start"].cast("int") * 4 + 1, p["length"].cast("int") * 4).alias("ids"),
                    ),
                )
            ),
        )
        .select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
    )


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents of ``documents`` packed, the sources in their own proportions."""
    return digest(pack(common.table(spark, sf_dir, "documents")))
