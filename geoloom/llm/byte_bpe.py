"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

The tree's leaf i holds the rank of the pair that begins at byte i (none: infinity), packed with i, so the root is the
leftmost lowest pair. A merge joins two live neighbours, then updates the leaves of the pair that begins at the merged
place, of the one before it and of the place that died, and their paths of log2(n) nodes in one pass. Trees of about one
size are worked on side by side as rows of an array; each row makes one merge a step and leaves when its root is
infinite. Distinct chunks of text are coded once per worker in a bounded cache, which keeps ids and decoded bytes.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import slices, texts
from geoloom.llm.chunks import SPACE, Cache, spaced_chunks

_NONE = np.int64(np.iinfo(np.int64).max)
#: Bytes in the trees worked on side by side.
_SIDE_BY_SIDE = 1 << 20
#: Pieces up to each of these lengths are worked on side by side.
_SIZES = [n for k in range(1, 40) for n in (1 << k, 3 << k - 1)]


def _cut(data: bytes, ends: np.ndarray, less: int = 0) -> list[bytes]:
    """``data`` cut at ``ends``, without the last ``less`` bytes of each part."""
    stops = ends.tolist()
    return [data[a : b - less] for a, b in zip([0, *stops], stops)]  # noqa: B905


class ByteBpe:
    """Ranks of a .tiktoken file; pieces are matches of ``pattern``."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {r: t for t, r in self.ranks.items()}
        self.decimal = {r: b"%d" % r for r in self.token}
        self.digits, self.sizes = np.zeros(max(self.token) + 1, np.int64), np.zeros(max(self.token) + 1, np.int64)
        for r, t in self.token.items():
            self.digits[r], self.sizes[r] = len(self.decimal[r]), len(t)
        # the pattern's white space is Unicode White_Space
        self.pattern = regex.compile(pattern.replace(r"[^\s", rf"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # every way in which two tokens join into a third
        keys, made = [], []
        for t, r in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.made = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank (which is the id) of each joined pair, or infinity; -1 joins with nothing."""
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.made[at], _NONE)

    def _merge_rows(self, ids: np.ndarray, size: int) -> np.ndarray:
        """ids: rows of ``size`` byte ids, padded with -1; returns them with merged places as -1."""
        n, wide = len(ids), size + 1
        # one more place a row, which stays -1: what lies after a row's last place, and before the next row's first
        place = np.arange(wide, dtype=np.int64)
        nxt, prv = np.tile(place + 1, n), np.tile(place - 1, n)
        leaf = np.full((n, size), _NONE)
        rank = self.pair(ids[:, :-1], ids[:, 1:])
        leaf[:, :-1] = np.where(rank == _NONE, _NONE, rank << 32 | place[: size - 1])
        tree = np.full((n, 2 * size), _NONE)
        tree[:, size:] = leaf
        top = size
        while top > 1:  # nodes top // 2 to top - 1 have both children at top and beyond
            low = (top + 1) // 2
            tree[:, low:top] = np.minimum(tree[:, 2 * low : 2 * top : 2], tree[:, 2 * low + 1 : 2 * top : 2])
            top = low
        tree = tree.reshape(-1)
        ids = np.hstack([ids, np.full((n, 1), -1)]).reshape(-1)
        live = np.arange(n)
        levels = (2 * size - 1).bit_length() - 1
        while True:
            least = tree[live * (2 * size) + 1]
            going = least != _NONE
            if not going.all():
                live, least = live[going], least[going]
            if not len(live):
                return ids.reshape(n, wide)[:, :size]
            row, root = live * wide, live * (2 * size)
            at, made = least & 0xFFFFFFFF, least >> 32
            right = nxt[row + at]
            after, before = nxt[row + right], prv[row + at]
            ids[row + at] = made
            ids[row + right] = -1
            nxt[row + at] = after
            prv[row + after] = at
            joined = self.pair(np.concatenate([made, ids[row + before]]), np.concatenate([ids[row + after], made]))
            own, left = joined[: len(live)], joined[len(live) :]
            own = np.where(own == _NONE, _NONE, own << 32 | at)
            left = np.where(left == _NONE, _NONE, left << 32 | before)
            first = before < 0
            before, left = np.where(first, at, before), np.where(first, own, left)
            # the leaves of the two live neighbours and the dead one, then their ancestors, level by level in one pass
            node, root = np.concatenate([right, at, before]) + size, np.concatenate([root, root, root])
            tree[root + node] = np.concatenate([np.full(len(live), _NONE), own, left])
            for _ in range(levels):
                node = np.maximum(node >> 1, 1)
                child = root + 2 * node
                tree[root + node] = np.minimum(tree[child], tree[child + 1])

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(places among the pieces, where the ids of each end, ids), part by part, every piece once."""
        whole, by_size = [], {}
        for i, p in enumerate(pieces):
            if p in self.ranks:
                whole.append(i)
            else:
                by_size.setdefault(bisect.bisect_left(_SIZES, len(p)), []).append(i)
        if whole:
            yield whole, np.arange(1, len(whole) + 1), np.array([self.ranks[pieces[i]] for i in whole], np.int64)
        for k, members in by_size.items():
            step = max(1, _SIDE_BY_SIDE // _SIZES[k])
            for j in range(0, len(members), step):
                part = members[j : j + step]
                lens = np.array([len(pieces[i]) for i in part], np.int64)
                size = int(lens.max())
                raw = np.frombuffer(b"".join([pieces[i].ljust(size, b"\0") for i in part]), np.uint8).reshape(len(part), size)
                ids = self._merge_rows(np.where(np.arange(size) < lens[:, None], self.byte_id[raw], -1), size)
                keep = ids >= 0
                yield part, np.cumsum(keep.sum(1)), ids[keep]

    def _code(self, chunks: list[str], spell, join) -> list:
        """For each chunk ``join`` of its pieces' values. ``spell`` gives the values of pieces that lie end to end."""
        seen: dict[str, int] = {}
        put, find = seen.setdefault, self.pattern.findall
        parts = [[put(m, len(seen)) for m in find(c)] for c in chunks]
        value: list = [None] * len(seen)
        for places, ends, ids in self.encode_pieces([m.encode() for m in seen]):
            for i, x in zip(places, spell(ids, ends), strict=True):
                value[i] = x
        return [value[p[0]] if len(p) == 1 else join([value[i] for i in p]) for p in parts]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Each chunk's ids as little-endian unsigned 32-bit numbers."""
        return self._code(chunks, lambda ids, ends: _cut(ids.astype("<u4").tobytes(), 4 * ends), b"".join)

    def trip_chunks(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Each chunk's ids in decimals joined by commas, and the bytes that the ids decode to."""

        def spell(ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
            """Both for all pieces at once, cut at the pieces' ends."""
            listed = ids.tolist()
            digits = b",".join(map(self.decimal.__getitem__, listed)) + b","
            at = np.cumsum(self.digits[ids] + 1)[ends - 1]
            return zip(_cut(digits, at, 1), _cut(self.decode(listed), np.cumsum(self.sizes[ids])[ends - 1]), strict=True)

        return self._code(chunks, spell, lambda found: (b",".join([x for x, _ in found]), b"".join([x for _, x in found])))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_caches: dict[tuple[str, str], tuple[ByteBpe, Cache, Cache]] = {}


def _coder(path: str, pattern: str) -> tuple[ByteBpe, Cache, Cache]:
    """The coder with its caches of ids and of round trips; one for all tasks of a worker."""
    if (path, pattern) not in _caches:
        bpe = ByteBpe(path, pattern)
        _caches[path, pattern] = bpe, Cache(bpe.encode_chunks), Cache(bpe.trip_chunks, 600_000)
    return _caches[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; null text: no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache, _ = _coder(path, pattern)
        for batch in slices(batches):
            chunks = [spaced_chunks(t) for t in texts(batch)]
            cache.fill(chunks)
            ids = [np.frombuffer(b"".join(map(cache.__getitem__, c)), "<u4").astype(np.int32) for c in chunks]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of (doc_id, ids); an id outside the vocabulary fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _, _ = _coder(path, pattern)
        for batch in batches:
            data = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return coded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every whole text and decode its ids again: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids (the digests of nothing); null ids stay null; repeated rows are each returned; an
    empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, cache = _coder(path, pattern)
        sha, value = hashlib.sha256, cache.__getitem__
        for batch in slices(batches):
            chunks = [spaced_chunks(t) for t in texts(batch)]
            cache.fill(chunks)
            n, ids_sha, data_sha = [], [], []
            for c in chunks:
                spelt, data = zip(*map(value, c), strict=True) if c else ((), ())
                ids = b",".join(spelt)
                n.append(ids.count(b",") + 1 if ids else 0)
                ids_sha.append(sha(ids).hexdigest())
                data_sha.append(sha(b"".join(data)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(data_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
