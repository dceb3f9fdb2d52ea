"""Texts as flat byte arrays, and polynomial (Rabin-Karp) hashes of their parts in numpy.

All hashes are sums of value x BASE^position modulo 2^64. With prefix sums, the hash of any run
is a difference shifted back by the inverse of the base, so no loop runs over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
OTHER_BASE = 0xD1342543DE82EF95
CHUNK_BYTES = 300_000  # texts hashed at once, unless a single one is longer

#: ASCII white space: space, and tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last ends; nulls are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` bytes; each text is in one range, whole."""
    _, offsets = flat(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the longest stretches of ``inside`` that stay in one text."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(inside))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _power(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` and its inverse to the powers 0 to ``n``."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = out[0], out[1]
        if n < 4 * CHUNK_BYTES:  # those of very long texts are not kept
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE
) -> np.ndarray:
    """Hash of ``values[start:end]`` for every run."""
    power, inverse = _power(len(values), base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for every word (run of other than ASCII white space), and its text."""
    data, offsets = flat(texts)
    starts, ends, text = runs(~IS_SPACE[data], offsets)
    return mix(run_hashes(data, starts, ends) ^ (ends - starts).astype(np.uint64)), text


def gram_hashes(words: np.ndarray, k: int, base: int = BASE) -> np.ndarray:
    """The Rabin-Karp hash of every ``k`` consecutive values (over text limits, too)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return mix(run_hashes(words, starts, starts + k, base))


def _sliding(f, x: np.ndarray, w: int) -> np.ndarray:
    """``f`` (minimum or maximum) of every ``w`` consecutive values."""
    have = 1
    while 2 * have <= w:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (w - have)], x[w - have :]) if w > have else x


def winnowed(hashes: np.ndarray, text: np.ndarray, k: int, w: int) -> np.ndarray:
    """True for the gram hashes that are the least of some ``w`` consecutive ones of their text.

    ``text`` is the text of every word. All of equal least ones are kept. Any stretch of
    ``w + k - 1`` words that two texts share has a kept hash in common.
    """
    keep = np.zeros(len(hashes), bool)
    if len(hashes) < w:
        return keep
    least = _sliding(np.minimum, hashes, w)
    least[text[: len(least)] != text[w + k - 2 :]] = 0  # of two texts
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    return (hashes == _sliding(np.maximum, padded, w)) & (hashes != 0)
