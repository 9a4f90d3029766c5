"""Texts as chunks that a tokenizer treats on their own, so that each distinct chunk is worked on once per worker."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable

import pyarrow as pa

#: The library's white space (Unicode White_Space); Python's own also has 0x1C-0x1F.
SPACE = "\t-\r \x85\xa0  -     　"
#: Where cutting before each single space would part a run of white space; plain substring tests are much the fastest.
_RUN = re.compile(f"[{SPACE}] | [{SPACE}]")
_PAIRS = [p for c in "\t\n\x0b\x0c\r " for p in ({c + " ", " " + c})]
_WIDE = SPACE[SPACE.index("\x85") :]
_ODD = "\x1c\x1d\x1e\x1f"
_SPLIT = re.compile(f"[{SPACE}]+")


def spelling() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


#: glibc's call that returns free memory to the system; other C libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system. A worker serves operator after operator, and its allocators keep the most that any
    needed beside what the next one takes."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


class Cache(dict):
    """chunk -> result, filled for many chunks at once; beyond ``limit`` chunks only those just asked for stay, so memory
    is bounded."""

    #: The cache in use: a worker that serves several operators in turn holds one filled cache at a time.
    used: "Cache | None" = None

    def __init__(self, work: Callable[[list[str]], Iterable], limit: int = 700_000):
        self.work, self.limit = work, limit

    @staticmethod
    def use(own: "Cache | None") -> None:
        """From now on the worker holds this cache alone, or none."""
        if Cache.used is not own:
            if Cache.used is not None:
                Cache.used.clear()
                give_back()
            Cache.used = own

    def fill(self, lists: list[list[str]]) -> None:
        Cache.use(self)
        need = set().union(*lists)
        if len(self) > self.limit:
            last = {x: self[x] for x in need if x in self}
            self.clear()
            self.update(last)
        need = [x for x in need if x not in self]
        self.update(zip(need, self.work(need), strict=True))


def spaced_chunks(text: str) -> list[str]:
    """Chunks that begin with at most one space, for tokenizers whose tokens may own the space before a word.

    Text whose white space comes in runs with spaces stays whole: there a cut could part a token.
    """
    if text[-1:] == " " or any(p in text for p in _PAIRS) or (not text.isascii() and any(c in text for c in _WIDE) and _RUN.search(text)):
        return [text]
    head, *rest = text.split(" ")
    return [head, *[" " + x for x in rest]] if head else [" " + x for x in rest]


def bare_chunks(text: str) -> list[str]:
    """Runs of anything but white space, for tokenizers that drop white space."""
    return [x for x in _SPLIT.split(text) if x] if any(c in text for c in _ODD) else text.split()
