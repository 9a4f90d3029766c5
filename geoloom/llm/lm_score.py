"""Language-model scores by a probabilistic suffix tree over tokens.

Symbols are tokens; a context is one or two tokens before one, in its document. Every run of two or three tokens that
occurs twice in the training documents is learned, whatever the size of the corpus, so the tree grows with it. A context
stays if its next-symbol distribution diverges from that of its longest proper suffix: a lower bound of the G statistic
over its runs must be over ``divergence`` for each of them. Distributions are smoothed by absolute discounting towards
the next shorter context that stayed, down to single-token frequencies, whose mass for unknown tokens is the share of
tokens seen once. Like the base score, the model's events are the known tokens and one more for any unknown token. A
token is scored in the longest suffix state of its past.

Documents are read once into blocks of about ``block_bytes`` of text, each with its own vocabulary, in a table bucketed
by block. The tree lies nowhere whole. Blocks ask and get answers by shuffles: a question is a packed row of sorted key
hashes with the block's counts, one for each range of hashes; whoever holds a range sums all blocks' counts, and the
answers go back in the same order. Three questions are asked: the counts of tokens and pairs; the counts of triples whose
pairs both occur twice; and, of every context, the sums over its runs (one block speaks for each run) that the divergence
test and the discounted mass need. A key has one entry in a block at most, so no key is hot. Only four totals reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import LOWER, held, mix, slices
from geoloom.session import stage_bucketed

#: Bytes of text after which a block may end. Smaller slices give more and smaller blocks, which ask for more keys.
SLICE_BYTES = 4 << 20
#: The end token; no word holds a line feed.
END = b"\n"
#: What is asked: totals of tokens, pairs and triples; sums of contexts of one and of two tokens.
TOKEN, PAIR, TRIPLE, ONE, TWO = range(5)
_NEXT = np.uint64(0xA24BAED4963EE407)
#: Gains are summed as whole numbers of this part, so that sums do not depend on their order.
_UNIT = 1 / 16
_BLOCK = "block long, docs array<long>, held array<boolean>, lens binary, codes binary, tokens long, train long, high binary, low binary"
_ASK = "kind int, bucket long, block long, keys binary, low binary, nums binary"
_ANSWER = "kind int, bucket long, block long, nums binary, known long, once long"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Mostly rising hashes, by their differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _longer(run: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The hash of a run of tokens with one token more."""
    return mix(run * _NEXT + token)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, where each first occurs, and the number of each given one.

    As np.unique, but plain numbers are sorted, which takes a fraction of the time: a key's high bits with its place in
    the low ones. Where that leaves keys alike in the high bits out of order, they are sorted whole.
    """
    n = len(keys)
    if not n:
        return keys, np.empty(0, np.int32), np.empty(0, np.int32)
    low = np.uint64((1 << n.bit_length()) - 1)
    place = keys << np.uint64(64 - int(keys.max()).bit_length() & 63)
    place &= ~low
    place |= np.arange(n, dtype=np.uint64)
    place.sort()
    place &= low
    order = place.astype(np.int32)
    del place
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable").astype(np.int32)
        ordered = keys[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    of = np.empty(n, np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], of


def _numbers(chosen: np.ndarray) -> np.ndarray:
    """For each place the number of chosen ones before it."""
    return np.cumsum(chosen, dtype=np.int32) - chosen


class _Vocabulary(dict):
    """Token -> its number, given out as tokens come."""

    def __missing__(self, token: bytes) -> int:
        self[token] = number = len(self)
        return number


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks: docs, held, lens and codes of the documents, numbers of all and of training tokens, 80-bit hashes of the vocabulary."""
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        vocabulary = _Vocabulary()
        ids, outs, coded = [], [], []

        def flush() -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in vocabulary), ">u8").reshape(-1, 2)
            high, low = raw[:, 0].astype(np.uint64), (raw[:, 1] & 0xFFFF).astype(np.uint16)
            lens = np.array([len(c) for c in coded], np.int64)
            flat = np.concatenate(coded)
            # frequent tokens get small numbers, so that codes pack well; those about as frequent go by hash
            often = np.frexp(np.bincount(flat, minlength=len(high)))[1]
            order = np.lexsort([low, high, -often])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            cols = [part << 32 | number, ids, outs, lens.tobytes(), _pack(rank[flat]), len(flat), int(lens[~np.array(outs, bool)].sum()), _pack_keys(high[order]), low[order].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, types, strict=True)], names)

        for batch in slices(batches, limit=SLICE_BYTES):
            put = vocabulary.__getitem__
            for doc, text, out in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = (text or "").encode().translate(LOWER).split()
                words.append(END)
                coded.append(np.fromiter(map(put, words), np.int32, len(words)))
                ids.append(doc)
                outs.append(out)
                size += len(text or "")
            if size >= block_bytes:
                yield flush()
                vocabulary, ids, outs, coded, number, size = _Vocabulary(), [], [], [], number + 1, 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, _BLOCK)


def _places(chosen: np.ndarray) -> np.ndarray:
    """Where ``chosen`` holds, in 32 bits."""
    return np.flatnonzero(chosen).astype(np.int32)


def _parts(x: np.ndarray) -> Iterator[slice]:
    """Slices of ``x`` whose intermediate results are small beside a block."""
    yield from (slice(i, i + (1 << 18)) for i in range(0, len(x), 1 << 18))


class Block:
    """A block's tokens and runs, and the answers it got. Keys are hashes of ``width`` bits.

    A block has a few million tokens, and what is kept of each of them counts in the memory of a task, so places and
    numbers within the block have 32 bits (:func:`_distinct` gives such as well).
    """

    def __init__(self, row: dict, width: int, answers: pa.Table | None = None):
        self.number, self.docs, self.held, self.shift = row["block"], row["docs"], row["held"], np.uint64(64 - width)
        self.lens = np.frombuffer(row["lens"], np.int64)
        self.codes = _unpack(row["codes"]).astype(np.int32)
        self.rows = np.repeat(np.arange(len(self.lens), dtype=np.int32), self.lens)
        self.high, self.low = _unpack_keys(row["high"]), np.frombuffer(row["low"], np.uint16)
        #: the vocabulary in the order of its hashes
        self.order = np.lexsort([self.low, self.high])
        # pairs: where one begins, its number among the distinct ones
        self.at = _places(self.rows[:-1] == self.rows[1:])
        pair = self._pair(self.at)
        pair >>= self.shift
        self.pairs, self.first, self.of = _distinct(pair)
        del pair
        if answers is None:
            return
        got: dict[int, list[np.ndarray]] = {}
        order = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        for kind, nums in zip(order.column("kind").to_pylist(), order.column("nums").to_pylist(), strict=True):
            got.setdefault(kind, []).append(_unpack(nums).reshape(2 if kind in (ONE, TWO) else 1, -1))
        del order
        self.got = {k: np.concatenate(got.pop(k), 1) for k in list(got)}
        #: totals of the vocabulary and of the pairs; which of them this block speaks for
        self.c = np.empty(len(self.high), np.int64)
        self.c[self.order] = self._answer(TOKEN)
        self.tells, self.c = self.c & 1, self.c >> 1
        self.n, self.speaks = self._answer(PAIR) >> 1, self._answer(PAIR) & 1 > 0
        # triples whose pairs both occur twice
        pair_at = np.full(len(self.codes) + 1, -1, np.int32)
        pair_at[self.at] = np.where(self.n[self.of] > 1, self.of, -1)
        self.at3 = _places((pair_at[:-1] >= 0) & (pair_at[1:] >= 0))
        self.before, self.after = pair_at[self.at3], pair_at[self.at3 + 1]
        triple = _longer(self._pair(self.at3), self.high[self.codes[self.at3 + 2]])
        triple >>= self.shift
        self.triples, self.first3, self.of3 = _distinct(triple)
        del triple
        #: where a frequent pair is the context of a token
        follows = np.zeros(len(self.codes), bool)
        follows[self.at] = True
        self.at2 = self.at[(pair_at[self.at] >= 0) & follows[np.minimum(self.at + 1, len(self.codes) - 1)]]
        self.two = pair_at[self.at2]

    def _pair(self, at: np.ndarray) -> np.ndarray:
        """The whole hash of the pair that begins at each place."""
        return _longer(self.high[self.codes[at]], self.high[self.codes[at + 1]])

    def train(self) -> np.ndarray:
        """Whether each token is in a training document."""
        return ~np.repeat(np.array(self.held, bool), self.lens)

    def _answer(self, kind: int, part: int = 0) -> np.ndarray:
        return self.got[kind][part] if kind in self.got else np.empty(0, np.int64)

    def contexts(self) -> tuple[np.ndarray, ...]:
        """Contexts of one token that occurs twice (codes, keys, the key's number for each) and of two (pair numbers)."""
        used = np.zeros(len(self.high), bool)
        used[self.codes[self.at]] = True
        codes = np.flatnonzero(used & (self.c > 1))
        keys, _, of = _distinct(mix(self.high[codes]) >> self.shift)
        before = np.zeros(len(self.pairs), bool)
        before[self.two] = True
        #: the number of each pair among those of two
        self.of_two = _numbers(before)
        return codes, keys, of, np.flatnonzero(before)

    def ask_counts(self, buckets: int) -> Iterator[pa.RecordBatch]:
        train = self.train()
        n = np.bincount(self.codes[train], minlength=len(self.high))[self.order]
        yield from self._ask(TOKEN, self.high[self.order], buckets, n[None], 64, self.low[self.order])
        yield from self._ask(PAIR, self.pairs, buckets, np.bincount(self.of, train[self.at], len(self.pairs)).astype(np.int64)[None])

    def ask_triples(self, buckets: int) -> Iterator[pa.RecordBatch]:
        yield from self._ask(TRIPLE, self.triples, buckets, np.bincount(self.of3, self.train()[self.at3], len(self.triples)).astype(np.int64)[None])

    def ask_contexts(self, buckets: int, total: int) -> Iterator[pa.RecordBatch]:
        """For every context the sums of gains, kinds and counts over the runs that this block speaks for, and its total if it speaks for it."""
        codes, keys, of, two = self.contexts()
        runs = np.flatnonzero(self.speaks & (self.n > 1))
        a, x, n = self.codes[self.at[self.first[runs]]], self.codes[self.at[self.first[runs]] + 1], self.n[runs]
        numbers = np.zeros(len(self.high), np.int64)
        numbers[codes] = of
        to = numbers[a]
        yield from self._ask(ONE, keys, buckets, self._sums(to, n, n / self.c[a] * (total / self.c[x]), np.bincount(of, (self.c * self.tells)[codes], len(keys))))
        v = self._answer(TRIPLE)
        runs = np.flatnonzero((v & 1 > 0) & (v > 3))
        at, n = self.first3[runs], v[runs] >> 1
        up = self.n[self.after[at]] / self.c[self.codes[self.at3[at] + 1]]
        yield from self._ask(TWO, self.pairs[two], buckets, self._sums(self.of_two[self.before[at]], n, n / self.n[self.before[at]] / up, (self.n * self.speaks)[two]))

    @staticmethod
    def _sums(to: np.ndarray, n: np.ndarray, ratio: np.ndarray, whole: np.ndarray) -> np.ndarray:
        gain = np.rint(2 * n * np.log(ratio) / _UNIT)
        return np.stack([np.bincount(to, w, len(whole)).astype(np.int64) for w in (gain, np.ones(len(n)), n)] + [whole.astype(np.int64)])

    def _ask(self, kind: int, keys: np.ndarray, buckets: int, nums: np.ndarray, width: int = 0, low: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """One row for each range of (sorted) keys."""
        top = (keys >> np.uint64(32) if width else keys << self.shift >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(top, prepend=np.uint64(2**63)))
        for start, end in zip(starts, [*starts[1:], len(keys)], strict=True):
            row = [kind, int(top[start]), self.number, _pack_keys(keys[start:end]), None if low is None else low[start:end].tobytes(), _pack(np.ascontiguousarray(nums[:, start:end]).ravel())]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], [c.split()[0] for c in _ASK.split(", ")])

    def scores(self, total: int, known: int, once: int, discount: float) -> pa.Table:
        unknown, c = max(once, 1) / (total + 1), self.c
        del self.first, self.first3, self.triples, self.after  # only questions need them
        base = np.log10((c + 1) / (total + 1 * (known + 1)))
        p = np.where(c > 0, (1 - unknown) * c / max(total, 1), unknown)[self.codes]
        if total:
            codes, _, of, two = self.contexts()
            left, keep = np.ones(len(c)), np.zeros(len(c), bool)
            keep[codes], left[codes] = self._left(ONE, of, c[codes], discount)
            for part in _parts(self.at):
                a = self.codes[self.at[part]]
                at = keep[a]
                n = self.n[self.of[part][at]]
                a, where = a[at], self.at[part][at] + 1
                p[where] = np.where(n > 1, n - discount, 0) / c[a] + left[a] * p[where]
            keep, left = self._left(TWO, np.arange(len(two)), self.n[two], discount)
            share = np.zeros(len(self.codes))
            triples = self._answer(TRIPLE)
            for part in _parts(self.at3):
                n = triples[self.of3[part]] >> 1
                share[self.at3[part]] = np.where(n > 1, n - discount, 0) / self.n[self.before[part]]
            for part in _parts(self.at2):
                to = self.of_two[self.two[part]]
                at = keep[to]
                where = self.at2[part][at] + 2
                p[where] = share[where - 2] + left[to[at]] * p[where]
            score = np.log10(p, out=p)
        else:
            score = np.zeros(len(p))
        m, starts = len(self.lens), np.cumsum(self.lens) - self.lens  # a document has its end at least

        def sums(x: np.ndarray) -> pa.Array:
            """Of each document, in long doubles: its sum doesn't depend on its block."""
            return pa.array(np.add.reduceat(x, starts, dtype=np.longdouble).astype(np.float64))

        return pa.table(
            {
                "doc_id": pa.array(self.docs, pa.int64()),
                "held_out": pa.array(self.held, pa.bool_()),
                "n_tokens": pa.array(self.lens),
                "n_known": pa.array(np.bincount(self.rows, weights=(c > 0)[self.codes], minlength=m).astype(np.int64)),
                "train_tokens": pa.array(np.full(m, total)),
                "base_score": sums(base[self.codes]),
                "score": sums(score),
            }
        )

    def _left(self, kind: int, of: np.ndarray, whole: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
        """Which contexts stay, and the mass each leaves to its suffix."""
        kinds, seen = self._answer(kind)[of], self._answer(kind, 1)[of]
        return kinds > 0, (discount * kinds + whole - seen) / np.maximum(whole, 1)


def _rows(kind: int, bucket: int, blocks: list[int], nums: list[np.ndarray], known: int = 0, once: int = 0) -> pa.Table:
    n = len(blocks)
    cols = [[kind] * n, [bucket] * n, blocks, [_pack(np.ascontiguousarray(x).ravel()) for x in nums], [known] + [0] * (n - 1), [once] + [0] * (n - 1)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=[c.split()[0] for c in _ANSWER.split(", ")])


def _read(asked: pa.Table) -> tuple[int, int, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """A range's questions: kind, bucket, blocks, where each block's keys end, the number of each key, all numbers."""
    asked = asked.sort_by("block").to_pydict()
    keys = [_unpack_keys(k) for k in asked["keys"]]
    flat = np.concatenate(keys)
    parts = [flat]
    if asked["low"][0] is not None:
        parts.insert(0, np.frombuffer(b"".join(asked["low"]), np.uint16))
    order = np.lexsort(parts)
    new = np.ones(len(flat), bool)
    new[1:] = np.any([p[order][1:] != p[order][:-1] for p in parts], axis=0)
    of = np.empty(len(flat), np.int64)
    of[order] = np.cumsum(new) - 1
    nums = np.concatenate([_unpack(n).reshape(-1, len(k)) for n, k in zip(asked["nums"], keys, strict=True)], 1)
    return asked["kind"][0], asked["bucket"][0], asked["block"], np.cumsum([len(k) for k in keys])[:-1], of, nums


def _totals(asked: pa.Table) -> pa.Table:
    """Twice the total of each key, and one more where the block is the first to name it; 0 for a run that occurs once."""
    kind, bucket, blocks, ends, of, nums = _read(asked)
    n = np.bincount(of, nums[0]).astype(np.int64)
    first = np.zeros(len(of), np.int64)
    first[np.unique(of, return_index=True)[1]] = 1
    v = np.where(n > (0 if kind == TOKEN else 1), 2 * n, 0)[of]
    counted = (int((n > 0).sum()), int((n == 1).sum())) if kind == TOKEN else (0, 0)
    return _rows(kind, bucket, blocks, np.split(v + first * (v > 0), ends), *counted)


def _tests(asked: pa.Table, divergence: float) -> pa.Table:
    """The number of kinds and the sum of the runs of each context that stays; 0 for the others."""
    kind, bucket, blocks, ends, of, nums = _read(asked)
    gain, kinds, seen = (np.bincount(of, x).astype(np.int64) for x in nums[:3])
    whole = np.maximum(np.bincount(of, nums[3]).astype(np.int64), seen)  # only one block tells it
    rest = whole - seen  # runs that occur once, as one symbol
    stay = gain * _UNIT + 2 * rest * np.log(np.maximum(rest, 1) / np.maximum(whole, 1)) > divergence * kinds
    return _rows(kind, bucket, blocks, np.split(np.where(stay, [kinds, seen], 0)[:, of], ends, axis=1))


def lm_score(docs: DataFrame, mod: int = 7, rest: int = 2, divergence: float = 8.0, discount: float = 0.75, block_bytes: int = 12 << 20, bucket_tokens: int = 1 << 21, spare_bits: int = 20) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words in lower case (A-Z) and one end. Trained on documents whose crc32(doc_id as text) mod ``mod`` is
    not ``rest``. Null and empty texts are the end token alone; a null id counts as the text ''; rows that repeat a
    doc_id are each learned and scored; without training documents nothing is known and every score is 0. An empty
    table gives no rows. Other columns are not read. Hashes of runs have ``spare_bits`` more bits than the number of
    tokens (64 at most), so a run is taken for another once in 2**spare_bits at most; tokens have 80-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held(F.col("doc_id"), mod, rest).alias("held_out"))
    blocks = stage_bucketed(_blocks(docs, block_bytes), "block")
    tokens, total = (int(x or 0) for x in blocks.agg(F.sum("tokens"), F.sum("train")).first())
    width, buckets = min(64, tokens.bit_length() + spare_bits), min(1 << 31, -(-tokens // bucket_tokens))

    def ask_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from Block(batch.slice(i, 1).to_pylist()[0], width).ask_counts(buckets)

    def asks(what):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return pa.Table.from_batches(what(Block(left.to_pylist()[0], width, right)), schema) if left.num_rows else schema.empty_table()

        schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("low", pa.binary()), ("nums", pa.binary())])
        return run

    def met(answers: DataFrame):
        return blocks.groupBy("block").cogroup(answers.select("kind", "bucket", "block", "nums").groupBy("block"))

    def answer(asked: DataFrame, how, more_of: DataFrame | None = None) -> DataFrame:
        return stage_bucketed(asked.groupBy("kind", "bucket").applyInArrow(how, _ANSWER), "block", move=True, more_of=more_of)

    counts = answer(blocks.mapInArrow(ask_counts, _ASK), _totals)
    known, once = (int(x or 0) for x in counts.agg(F.sum("known"), F.sum("once")).first())
    answers = answer(met(counts).applyInArrow(asks(lambda b: b.ask_triples(buckets)), _ASK), _totals, counts)
    answers = answer(met(answers).applyInArrow(asks(lambda b: b.ask_contexts(buckets, total)), _ASK), lambda t: _tests(t, divergence), answers)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return Block(left.to_pylist()[0], width, right).scores(total, known, once, discount)

    return met(answers).applyInArrow(score, _SCORED)
