"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie in one flat array of symbol ids with row offsets (a ragged array). In each round every row
finds the lowest merge rank among its neighbouring pairs, all rows merge all places of that pair at once, and rows
without a mergeable pair leave. What is left of a row is its token count. A merge makes a symbol whose own pairs rank
later than the pair it came from, so merging all places of the lowest pair at once equals the library's one by one.
Long rows are linked lists instead, and a round touches only the places of one rank and their neighbours.

Counts are kept per distinct white-space-free chunk in a bounded worker cache; a document's count is their sum.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import slices, texts
from geoloom.llm.chunks import Cache, bare_chunks, spelling

_NONE = np.iinfo(np.int64).max
#: Rows of more symbols are merged rank by rank.
_LONG = 64


def _every_second(new_run: np.ndarray) -> np.ndarray:
    """In a run of overlapping hits (a a a) every second one merges, from the left."""
    place = np.arange(len(new_run))
    return (place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0


class Merger:
    """Merges of a BPE vocabulary over ragged arrays of symbol ids."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], np.array(made, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.order[at], _NONE)

    def sizes(self, flat: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Symbols left of each row."""
        out, long = np.zeros(len(lens), np.int64), lens > _LONG
        of = np.repeat(long, lens)
        out[long] = self._merge_long(flat[of], lens[long])
        where = np.flatnonzero(~long)
        for rows, left in self._merge_short(flat[~of], lens[~long]):
            out[where[rows]] = left
        return out

    def _merge_long(self, flat: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """All rows at once, rank by rank. A merge makes pairs of later ranks only, so each rank comes once, and a round
        touches the places of its pair and their neighbours: the work grows with the symbols, not with rounds x symbols."""
        n = len(flat)
        if not n:
            return np.zeros(len(lens), np.int64)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(lens)
        nxt[ends - 1], prv[ends - lens] = n, -1
        symbol = np.append(flat, -1)  # place n (and -1) lies beyond every row
        live, rank = np.ones(n, bool), np.full(n + 1, _NONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(places: np.ndarray) -> None:
            """Rank the pairs that begin at ``places``."""
            now = self.ranks(symbol[places], symbol[nxt[places]])
            rank[places] = now
            order = np.argsort(now, kind="stable")
            places, now = places[order], now[order]
            cut = np.flatnonzero(np.diff(now, prepend=-1))
            for r, part in zip(now[cut].tolist(), np.split(places, cut[1:]), strict=True):
                if r != _NONE:
                    if r not in waiting:
                        waiting[r] = []
                        heapq.heappush(heap, r)
                    waiting[r].append(part)

        put(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[live[at] & (rank[at] == r)]
            if not len(at):
                continue
            at = at[_every_second(np.append(True, nxt[at[:-1]] != at[1:]))]
            gone = nxt[at]
            symbol[at] = self.made[r]
            live[gone], rank[gone] = False, _NONE
            nxt[at] = nxt[gone]
            some = nxt[at] < n
            prv[nxt[at[some]]] = at[some]
            before = prv[at]
            put(np.union1d(at, before[before >= 0]))
        return np.add.reduceat(live.astype(np.int64), ends - lens)

    def _merge_short(self, flat: np.ndarray, lens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields (rows, symbols left of each) as rows end; every row once."""
        rows = np.arange(len(lens))
        while len(rows):
            heads = np.cumsum(lens) - lens
            rank = np.full(len(flat), _NONE)
            if len(flat) > 1:
                rank[:-1] = self.ranks(flat[:-1], flat[1:])
            rank[heads + lens - 1] = _NONE  # no pair over a row's end
            least = np.minimum.reduceat(rank, heads)
            ended = least == _NONE
            of = np.repeat(np.arange(len(lens)), lens)
            if ended.any():
                yield rows[ended], lens[ended]
                live = ~ended[of]
                flat, rank, of = flat[live], rank[live], of[live]
                rows, lens, least = rows[~ended], lens[~ended], least[~ended]
                of = np.repeat(np.arange(len(lens)), lens)
                if not len(rows):
                    return
            hit = rank == least[of]
            at = np.flatnonzero(hit)
            at = at[_every_second(np.diff(at, prepend=-2) > 1)]
            flat[at] = self.made[rank[at]]
            keep = np.ones(len(flat), bool)
            keep[at + 1] = False
            lens = lens - np.bincount(of[at], minlength=len(lens))
            flat = flat[keep]


class WordTokenizer:
    """A tokenizers .json of kind BPE with word ends, byte symbols and white space dropped."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merger = Merger([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        self.library = Tokenizer.from_file(path)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        spell = spelling()
        self.inner = np.array([vocab[spell[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[spell[b] + end] for b in range(256)], np.int64)
        self.bytes_of = {c: b for b, c in spell.items()}

    def pre_tokens(self, segment: str) -> list[bytes]:
        if segment.isascii():
            return [x.encode() for x in self.pattern.findall(segment.lower())]
        norm = self.library.normalizer.normalize_str(segment)
        return [bytes(map(self.bytes_of.__getitem__, x)) for x, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def count(self, chunks: list[str]) -> list[int]:
        """Tokens of each chunk; special strings inside a chunk are one token each, as the library has it."""
        counts = np.zeros(len(chunks), np.int64)
        seen: dict[bytes, int] = {}
        uses, of = [], []
        for i, chunk in enumerate(chunks):
            segments = [chunk]
            if self.special and "<|" in chunk:
                segments = self.special.split(chunk)
                counts[i] = len(segments) - 1
            for segment in segments:
                for word in self.pre_tokens(segment) if segment else ():
                    uses.append(seen.setdefault(word, len(seen)))
                    of.append(i)
        if seen:
            words = list(seen)
            lens = np.array([len(w) for w in words], np.int64)
            raw = np.frombuffer(b"".join(words), np.uint8)
            flat = self.inner[raw]
            ends = np.cumsum(lens) - 1
            flat[ends] = self.last[raw[ends]]
            size = self.merger.sizes(flat, lens)
            counts += np.bincount(of, weights=size[uses], minlength=len(chunks)).astype(np.int64)
        return counts.tolist()


_caches: dict[str, Cache] = {}


def _cache(path: str) -> Cache:
    """The counts of a vocabulary's chunks; one for all tasks of a worker."""
    if path not in _caches:
        _caches[path] = Cache(WordTokenizer(path).count)
    return _caches[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 bytes and 0 tokens; null ids stay null; repeated rows are each counted; an empty table
    gives no rows; other columns are not read. Whole texts of any length are counted, slice by slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path)
        for batch in slices(batches):
            chunks = [bare_chunks(t) for t in texts(batch)]
            cache.fill(chunks)
            counts = [sum(map(cache.__getitem__, c)) for c in chunks]
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
