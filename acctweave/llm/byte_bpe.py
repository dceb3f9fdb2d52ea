"""Byte-level BPE on numpy matrices: encoding with a rank file, and decoding.

The distinct pieces of a batch are put into matrices by length, a row of token ids for each piece.
In every round each row merges its leftmost pair of lowest rank; ranks are looked up in a hash
table of pairs, only the two pairs beside a merge are looked up anew, and rows without a mergeable
pair leave the matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common, rolling
from acctweave.llm.chunk_cache import ChunkCache

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CELLS = 4_000_000  # of a matrix; longer pieces get one of their own
NONE = np.int32(2**31 - 1)  # the rank of a pair that doesn't merge


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Vocabulary:
    tokens: list[bytes]  # by id
    of_byte: np.ndarray  # the ids of the 256 single bytes
    keys: np.ndarray  # hash table: pair of ids, or all ones
    ranks: np.ndarray
    bits: int
    probes: int

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank (and id) that each pair merges to; NONE if it doesn't, or an id is negative."""
        key = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        at = _slots(key, self.bits)
        out = np.where(self.keys[at] == key, self.ranks[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.ranks[at] != NONE))
        mask = (1 << self.bits) - 1
        for step in range(1, self.probes):
            if not len(open_):
                break
            slot = (at[open_] + step) & mask
            hit = self.keys[slot] == key[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            open_ = open_[~hit & (self.ranks[slot] != NONE)]
        return out


@cache
def vocabulary(path: str = RANKS) -> Vocabulary:
    """Read a rank file: a line of base64 token and rank each."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, lines))}
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    pairs = [
        ((ranks[t[:i]] << 32) | ranks[t[i:]], r)
        for t, r in ranks.items()
        for i in range(1, len(t))
        if t[:i] in ranks and t[i:] in ranks
    ]
    keys = np.array([k for k, _ in pairs], np.uint64)
    values = np.array([r for _, r in pairs], np.int32)
    bits = max(8, int(np.ceil(np.log2(4 * max(1, len(keys))))))
    table = np.full(1 << bits, 2**64 - 1, np.uint64)
    held = np.full(1 << bits, NONE, np.int32)
    slot, rest, probes = _slots(keys, bits), np.arange(len(keys)), 0
    while len(rest):  # linear probing, all keys at once: the first of those that meet stays
        place = (slot[rest] + probes) & ((1 << bits) - 1)
        _, first = np.unique(place, return_index=True)
        first = first[held[place[first]] == NONE]
        table[place[first]], held[place[first]] = keys[rest[first]], values[rest[first]]
        rest = np.delete(rest, first)
        probes += 1
    of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return Vocabulary(tokens, of_byte, table, held, bits, probes + 1)


def _merge(ids: np.ndarray, v: Vocabulary) -> list[np.ndarray]:
    """The ids of each row of a matrix of byte ids, padded with -1."""
    out: list[np.ndarray] = [None] * len(ids)
    row = np.arange(len(ids))
    ranks = v.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    ranks[ids[:, 1:] < 0] = NONE
    while len(row):
        if ranks.shape[1] == 0:
            done = np.ones(len(row), bool)
        else:
            at = ranks.argmin(axis=1)  # the first of equal minima
            best = ranks[np.arange(len(row)), at]
            done = best == NONE
        if done.any():
            for r, found in zip(row[done], ids[done], strict=True):
                out[r] = found[found >= 0]
            keep = ~done
            row, ids, ranks = row[keep], ids[keep], ranks[keep]
            if not len(row):
                break
            at, best = at[keep], best[keep]
        n, width = ids.shape
        line = np.arange(n)
        # the right half of the merged pair goes, all beyond moves up by one
        kept = np.ones((n, width), bool)
        kept[line, at + 1] = False
        ids = ids[kept].reshape(n, width - 1)
        ids[line, at] = best
        kept = kept[:, 1:]
        ranks = ranks[kept].reshape(n, width - 2)
        for near in (at - 1, at):
            ok = np.flatnonzero((near >= 0) & (near < width - 2))
            left, right = ids[ok, near[ok]], ids[ok, near[ok] + 1]
            ranks[ok, near[ok]] = np.where(right < 0, NONE, v.rank(left, right))
    return out


def encode_pieces(pieces: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """The ids of each piece; pieces are merged together by length, padded to powers of two."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
    size = np.array([len(p) for p in pieces], np.int64)
    width = np.where(size > 8, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), size)
    order = np.argsort(width, kind="stable")
    limits = np.flatnonzero(np.diff(width[order], prepend=-1, append=-2))
    for a, b in zip(limits[:-1], limits[1:], strict=True):
        w = int(width[order[a]])
        step = max(1, CELLS // max(1, w))
        for k in range(a, b if w else a, step):
            rows = order[k : min(k + step, b)]
            ids = np.full((len(rows), int(size[rows].max())), -1, np.int32)
            flat = np.frombuffer(b"".join([pieces[i] for i in rows]), np.uint8)
            ids[np.arange(ids.shape[1]) < size[rows][:, None]] = v.of_byte[flat]
            for i, found in zip(rows, _merge(ids, v), strict=True):
                out[i] = found
    return out


class Encoder:
    """Ids of texts by a rank file and a splitting pattern, as the tiktoken library would."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        self.find = regex.compile(pattern).findall
        self.cache = ChunkCache(self._chunks)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        pieces = [self.find(c) for c in chunks]
        distinct = {p: None for ps in pieces for p in ps}
        found = encode_pieces([p.encode() for p in distinct], self.vocabulary)
        ids = {p: i.astype(np.int32).tobytes() for p, i in zip(distinct, found, strict=True)}
        return [b"".join([ids[p] for p in ps]) for ps in pieces]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b, np.int32) for b in self.cache.texts(texts)]


@cache
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(text: Column, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The token ids of whole texts, an array of int. Null and empty texts have none.

    The pattern must begin a new piece at a single space between two visible characters, as those
    of the byte-level vocabularies do.
    """

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, pattern)
        for texts in batches:
            rows = []
            for start, stop in rolling.chunks(texts):
                part = texts.slice(start, stop - start).to_pylist()
                rows += encoder.texts([t or "" for t in part])
            places = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(r) for r in rows], out=places[1:])
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(places), pa.array(flat, pa.int32()))

    return F.arrow_udf(ids, "array<int>")(text)


def decode(ids: Column, path: str = RANKS) -> Column:
    """The bytes that token ids stand for; a null array gives no bytes, an unknown id an error."""

    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = vocabulary(path).tokens.__getitem__
        for rows in batches:
            yield pa.array([b"".join(map(token, r or ())) for r in _rows(rows)], pa.binary())

    return F.arrow_udf(joined, "binary")(ids)


def _rows(rows: pa.Array) -> Iterator[list[int]]:
    flat, places = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
    for a, b in zip(places[:-1], places[1:], strict=True):
        yield flat[a:b].tolist()


def digests(ids: Column, path: str = RANKS) -> Column:
    """SHA-256, in hex, of the decimal ids joined by one space, and of the bytes they stand for."""

    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path).tokens
        names = [str(i).encode() for i in range(len(tokens))]
        for rows in batches:
            found = [
                (sha256(b" ".join(map(names.__getitem__, r))), sha256(b"".join(map(tokens.__getitem__, r))))
                for r in _rows(rows)
            ]
            yield pa.StructArray.from_arrays(
                [pa.array([f[k].hexdigest() for f in found], pa.string()) for k in (0, 1)], ["ids", "decoded"]
            )

    return F.arrow_udf(hashed, "ids string, decoded string")(ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` encoded and decoded again."""
    docs = common.table(spark, sf_dir, "documents")
    return (
        docs.select("doc_id", encode(F.col("text")).alias("ids"))
        .select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digests(F.col("ids")).alias("d"))
        .select("doc_id", "n_tokens", F.col("d.ids").alias("ids_sha256"), F.col("d.decoded").alias("decoded_sha256"))
    )
