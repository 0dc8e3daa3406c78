"""Whole texts to token ids through a memory of space-separated chunks.

The split pattern of byte-level vocabularies starts a new piece at every space
that touches no other white space, so the ids of a text are those of its chunks
(a space and what follows it) in turn.  A text that has a space beside other
white space goes through the pattern as a whole.
"""

from __future__ import annotations

from collections.abc import Callable


class Generations(dict):
    """key -> ``make(key)``, remembered for short keys; two generations bound the memory."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


class _Touching(Exception):
    """A chunk that begins or ends in white space, or is empty."""


class ChunkEncoder:
    """``encode`` maps any text to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode: Callable[[str], bytes], size: int = 1 << 18):
        def chunk(lead: str) -> Callable[[str], bytes]:
            def make(text: str) -> bytes:
                if not text or text[0].isspace() or text[-1].isspace():
                    raise _Touching
                return encode(lead + text)
            return make

        self.whole = encode
        self.first, self.rest = Generations(chunk(""), 1 << 12), Generations(chunk(" "), size)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        head, *tail = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.rest.__getitem__, tail))
        except _Touching:
            return self.whole(text)
