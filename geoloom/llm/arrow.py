"""Array helpers shared by the text operators; they run inside Arrow tasks on one bounded slice at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.chunks import Cache, give_back

#: Bytes of text that a task works on at once; less where every byte becomes several 64-bit numbers.
SLICE_BYTES, WORD_BYTES = 2 << 20, 1 << 20

#: Lower-cases A-Z and nothing else.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOWER = np.frombuffer(LOWER, np.uint8)
#: 0x20 and 0x09-0x0D part words; so does bytes.split().
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The same, and ASCII punctuation as well.
_BREAK = _SPACE.copy()
_BREAK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: One random odd 64-bit number for each byte value.
_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_QUAD = 0xD6E8FEB86659FD93


def held(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is ``rest``; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(mod)) == rest


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds at most about ``limit`` bytes of ``column`` (one row at least). What the
    worker's tasks before this one freed goes back to the system first."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(at, end - at)
            done, at = int(sizes[end - 1]), end


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def flat_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each text begins (one more entry for the end)."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a slice of texts, as arrays: byte ranges, 64-bit hashes and the text each belongs to."""

    def __init__(self, batch: pa.RecordBatch, lower: bool, column: str = "text", punctuation: bool = False):
        """``punctuation``: ASCII punctuation parts words too. Operators on words keep no chunks."""
        Cache.use(None)
        flat, offsets = flat_bytes(batch, column)
        self.flat = flat = _LOWER[flat] if lower else flat
        inside = ~(_BREAK if punctuation else _SPACE)[flat]
        before = np.zeros(len(flat), bool)
        before[1:] = inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < len(flat)]
        before[firsts] = False  # a word never runs into the next text
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(flat), bool)
        after[:-1] = inside[1:]
        after[firsts[firsts > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: first word of each text, one more entry for the end
        self.first = np.searchsorted(self.starts, offsets)
        self.rows = len(offsets) - 1

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes."""
        lens = self.ends - self.starts
        if not len(lens):
            return np.empty(0, np.uint64)
        heads = np.zeros(len(lens), np.int64)
        np.cumsum(lens[:-1], out=heads[1:])
        at = np.arange(int(lens.sum())) - np.repeat(heads, lens)
        power = np.ones(int(lens.max()), np.uint64)
        power[1:] = np.cumprod(np.full(len(power) - 1, _BASE))
        value = _BYTE[self.flat[np.repeat(self.starts, lens) + at]] * power[at]
        return mix(np.add.reduceat(value, heads) + lens.astype(np.uint64))

    def of_row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.flat[self.starts[i] : self.ends[i]].tobytes()


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive words (row borders are the caller's matter); doubling, so log2(k) passes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, part, size, power, unit, left = None, 0, h, 1, _QUAD, 1, k
    while left:
        if left & 1:
            piece = part[done : done + n] * np.uint64(unit)
            out = piece if out is None else out + piece
            done, unit = done + size, unit * power % 2**64
        left >>= 1
        if left:
            part = part[: len(part) - size] + part[size:] * np.uint64(power)
            size, power = size * 2, power * power % 2**64
    return mix(out)


def shingle_sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text end to end, and the number in each text."""
    words = Words(batch, lower=True)
    h = words.hashes()
    grams = gram_hashes(h, k)
    out, sizes = [], np.zeros(words.rows, np.int64)
    for i in range(words.rows):
        a, b = words.first[i], words.first[i + 1]
        if b == a:
            continue
        # fewer than k words: the whole sequence is the one shingle
        s = np.unique(grams[a : b - k + 1]) if b - a >= k else gram_hashes(h[a:b], int(b - a)) + np.uint64(b - a)
        out.append(s)
        sizes[i] = len(s)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), sizes
