"""Texts in parts that a byte-level tokenizer encodes on their own, and a cache of their ids.

Between two characters that are no blanks a single space always begins a new match of the public
split pattern, so a text falls into segments there, and a text's ids are those of its segments one
after another. Segments repeat far more often than texts do. Texts with other blanks next to a
space are one segment as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

CACHED = 200_000  # segments that a Python worker keeps

_UNSAFE = re.compile(r" (?:\s|\Z)|\s ")


# ids of texts, each as little-endian unsigned 32-bit numbers
EncodeMany = Callable[[list[str]], list[bytes]]


def segments(text: str) -> list[str]:
    if _UNSAFE.search(text):
        return [text]
    head, *rest = text.split(" ")
    return [head, *[" " + s for s in rest]]


class Recent:
    """What was used lately, in two generations: the older goes when the newer is full."""

    def __init__(self, limit: int):
        self.limit, self.known, self.older = limit, {}, {}

    def missing(self, keys: Iterable[list[str]]) -> list[str]:
        """The keys of some lists that are not held; all others are in ``known`` afterwards."""
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        out = []
        for key in set().union(*keys).difference(self.known):
            if key in self.older:
                self.known[key] = self.older[key]
            else:
                out.append(key)
        return out


class SegmentCache:
    """Encodes texts by their segments; what is new in a block of texts is encoded together."""

    def __init__(self, encode: EncodeMany, limit: int = CACHED):
        self.encode, self.recent = encode, Recent(limit)

    def ids(self, texts: Iterable[str]) -> list[bytes]:
        parted = [segments(t) for t in texts]
        fresh = self.recent.missing(parted)
        known = self.recent.known
        known.update(zip(fresh, self.encode(fresh)))
        out = [b"".join(map(known.__getitem__, parts)) for parts in parted]
        for parts in parted:  # whole texts are not kept
            if len(parts) == 1:
                known.pop(parts[0], None)
        return out
