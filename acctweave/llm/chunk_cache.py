"""Encode texts by way of their distinct space-separated chunks, which are remembered.

A single space between two characters that are no white space always begins a new piece of the
byte-level splitting pattern, so a text's ids are those of its chunks, in order: the first as it
is, the others with their space in front.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

#: Chunks kept by a worker: two generations of at most so many, whatever the corpus holds.
REMEMBERED = 200_000

#: The white space of ``\s`` other than a space.
_OTHERS = "\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Between Latin letters and other visible ASCII; the splitting pattern always cuts there.
_EDGE = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ɏ])(?=[!-@\[-`{-~])")
MARK = "\x01"  # begins a chunk that has no space in front


def _near_space(text: str) -> bool:
    """Whether a space meets other white space; searches for fixed texts, as a pattern takes longer."""
    return "  " in text or any(w in text and (f" {w}" in text or f"{w} " in text) for w in _OTHERS)


def split(text: str) -> list[str]:
    """The chunks of a text, without the spaces between them; whole runs of white space stay."""
    return _CUT.split(text) if _near_space(text) else text.split(" ")


class ChunkCache:
    """Ids (as bytes) of texts; ``encode`` gives those of a list of strings, none of them without ids.

    With ``cores``, letters and what follows them, such as a word and its comma, are chunks of their
    own. It takes a splitting pattern that keeps runs of letters apart from all others, but for a space
    in front, and special tokens that all begin with ``<``: texts that hold one keep their chunks.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Sequence[bytes]],
        remembered: int = REMEMBERED,
        cores: bool = False,
    ):
        self.encode, self.remembered, self.cores = encode, remembered, cores
        self.now: dict[str, bytes] = {}  # by chunk, its space left out
        self.before: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[bytes]:
        if len(self.now) > self.remembered:
            self.before, self.now = self.now, {}
        heads, rows, unknown = [], [], set()
        get = self.now.get
        for text in texts:
            if not self.cores:
                head, *chunks = split(text)
            elif MARK in text:
                head, chunks = text, []
            else:
                head, *chunks = split(text if "<" in text else _EDGE.sub(f" {MARK}", text))
            found = list(map(get, chunks))
            gaps = [] if all(found) else [k for k, ids in enumerate(found) if ids is None]
            missed = [chunks[k] for k in gaps]
            unknown.update(missed)
            heads.append(head)
            rows.append((found, gaps, missed))
        first = self._learn(unknown, heads)
        now = self.now
        out = []
        for head, (found, gaps, chunks) in zip(first, rows, strict=True):
            for k, chunk in zip(gaps, chunks, strict=True):
                found[k] = now[chunk]
            out.append(head + b"".join(found))
        return out

    def _learn(self, unknown: set[str], heads: list[str]) -> Sequence[bytes]:
        """Remember the ids of ``unknown`` chunks; returns those of ``heads``."""
        now, before = self.now, self.before
        new = []
        for c in unknown:
            known = before.get(c)
            if known is None:
                new.append(c)
            else:
                now[c] = known
        ids = self.encode([c[1:] if self.cores and c.startswith(MARK) else " " + c for c in new] + heads)
        now.update(zip(new, ids, strict=False))
        return ids[len(new) :]
