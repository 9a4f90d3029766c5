"""Toxicity scores by a support vector machine on a gap-weighted subsequence kernel, with Nystroem landmarks.

The units of a sentence are its words without punctuation, lower-cased, and runs of single characters read as one word
("i d i o t", "i.d.i.o.t"); units longer than ``span`` are read in overlapping windows. In labelled sentences a unit
counts once between the same two neighbours, so a text copied or edited a thousand times weighs little. The kernel of two units counts the
subsequences of ``order`` characters they share, each discounted by the length it spans, so inserted characters and
gaps cost little; it is normalised. Landmarks are units that mark toxic sentences; a unit's kernel values with them,
whitened by the landmarks' own kernel matrix, are its features; some landmarks are clean units that look like them. A
linear SVM on units of labelled sentences gives a unit's margin. A logistic curve over the three worst distinct tokens'
margins, fitted on labelled documents, gives the document's score.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import held, slices, texts
from geoloom.llm.chunks import Cache
from geoloom.session import stage

_PLAIN = re.compile(r"[\W_]+")
#: A unit's first character, so that kernels see where it begins.
_START = "^"
#: Tokens of a document that its score looks at: the worst ones.
WORST = 3
#: Units whose kernels are worked out together, and rows in one array step (they fit a core's cache).
_TOGETHER, _ROWS = 1 << 15, 4096
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def units_of(token: str, span: int = 24) -> list[str]:
    """A token's units: itself without punctuation, or windows of it, each after a start mark."""
    unit = (token if token.isalnum() else _PLAIN.sub("", token)).lower()
    if len(unit) <= span:
        return [_START + unit] if unit else []
    return [_START + unit[i : i + span] for i in range(0, len(unit) - span // 2, span // 2)]


def spelled(tokens: list[str]) -> list[str]:
    """Words spelled out in three or more single characters, one a token ("s t u p i d", "m. o. r."), joined."""
    lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
    single = [i for i in np.flatnonzero(lens < 3).tolist() if len(tokens[i]) == 1 or not tokens[i].isalnum()]
    out: list[str] = []
    run: list[str] = []
    last = -2
    for i in [*single, -9]:
        if i != last + 1:
            if len(run) > 2:
                out.append("".join(run))
            run = []
        last = i
        run.append(tokens[i] if i >= 0 else "")
    return [x for x in out if len(_PLAIN.sub("", x)) > 2]


def _codes(units: list[str], length: int) -> np.ndarray:
    raw = "".join([u.ljust(length, "\0") for u in units]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.int32).reshape(len(units), length)


def _kernel(s: np.ndarray, t: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Subsequence kernel of each row of codes s (n, L), shortest first, with t: (T, 1), one text for all, or (T, n), one
    for each; 0 pads.

    The usual recursion over the characters of s; rows lie along the last axis, so every step is a few long products,
    over those rows that still have a character.
    """
    n, size = len(s), len(t)
    place = np.arange(size)
    gap = place[:, None] - place[None, :]
    spread = np.where(gap >= 0, np.float32(decay) ** (gap + 2), 0).astype(np.float32)  # a match at b' seen from the prefix that ends at b
    fill = t != 0
    columns = np.ascontiguousarray(s.T)
    ended = np.searchsorted((s != 0).sum(1), np.arange(s.shape[1]), "right")
    # state[i][b]: subsequences of i + 1 characters with a match in the first b characters of t, discounted to its end
    state = np.zeros((order - 1, size + 1, n), np.float32)
    total = np.zeros(n, np.float32)
    for a, lo in enumerate(ended.tolist()):
        if lo == n:
            break
        own, some = (t, fill) if t.shape[1] == 1 else (t[:, lo:], fill[:, lo:])
        match = ((columns[a, lo:][None] == own) & some).astype(np.float32)
        total[lo:] += (match * state[-1, :-1, lo:]).sum(0)
        for i in range(order - 2, -1, -1):
            state[i, :, lo:] *= np.float32(decay)
            state[i, 1:, lo:] += spread @ (match if i == 0 else match * state[i - 1, :-1, lo:])
    return np.float32(decay**2) * total


def _shared(s: np.ndarray, marks: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each unit (row of codes) with each mark, by bit-parallel sums."""
    kinds = sorted({ord(c) for m in marks for c in m})
    place = np.array([[sum(1 << i for i, c in enumerate(m) if ord(c) == k) for m in marks] for k in [0, *kinds]], np.uint64)
    at = np.searchsorted(kinds, s)
    at = np.where(np.array([*kinds, -1])[at] == s, at + 1, 0)
    full = np.array([(1 << len(m)) - 1 for m in marks], np.uint64)
    v = np.broadcast_to(full, (len(s), len(marks))).copy()
    for a in range(s.shape[1]):
        u = v & place[at[:, a]]
        v = ((v + u) | (v - u)) & full
    return np.bitwise_count(~v & full)


def kernel(units: list[str], marks: list[str], order: int, decay: float) -> np.ndarray:
    """Normalised kernel values of units with marks. Without a common subsequence of ``order`` characters it is 0."""
    out = np.zeros((len(units), len(marks)), np.float32)
    if not units or not marks:
        return out
    rows = [_codes([m], len(m)) for m in marks]
    own_t = [float(_kernel(t, t.T, order, decay)[0]) for t in rows]
    by_length = np.array(sorted(range(len(units)), key=lambda i: len(units[i])))
    for at in range(0, len(units), _TOGETHER):
        part = by_length[at : at + _TOGETHER]
        s = _codes([units[i] for i in part.tolist()], max(1, len(units[part[-1]])))
        near = np.vstack([_shared(s[i : i + _ROWS], marks) >= order for i in range(0, len(s), _ROWS)])
        own = np.zeros(len(part), np.float32)
        for row in _blocks(near.any(1)):
            own[row] = _kernel(s[row], np.ascontiguousarray(s[row].T), order, decay)
        for j, t in enumerate(rows):
            for row in _blocks(near[:, j]):
                out[part[row], j] = _kernel(s[row], t.T, order, decay) / np.sqrt(np.maximum(own[row] * own_t[j], 1e-30))
    return out


def _blocks(chosen: np.ndarray) -> Iterator[np.ndarray]:
    """The chosen places, ``_ROWS`` at a time."""
    found = np.flatnonzero(chosen)
    for i in range(0, len(found), _ROWS):
        yield found[i : i + _ROWS]


class Sums:
    """Weighted sums of a unit's kernels with marks, before the unit's own norm.

    The sum over the marks is one sum over the subsequences they hold, each with a weight of its own. These lie in a trie
    with a table for each depth, and the units' partial matches walk it side by side; most end after two or three characters.
    """

    def __init__(self, marks: list[str], weight: np.ndarray, order: int, decay: float):
        self.order, self.decay = order, decay
        self.kinds = np.array(sorted({ord(c) for m in marks for c in m}), np.int32)
        norm = [float(_kernel(t, t.T, order, decay)[0]) for t in (_codes([m], len(m)) for m in marks)]
        ends: dict[tuple[int, ...], float] = {}
        for mark, w, n in zip(marks, weight.tolist(), norm, strict=True):
            codes = np.searchsorted(self.kinds, [ord(c) for c in mark]).tolist()
            for at in combinations(range(len(codes)), order):
                found = tuple(codes[i] for i in at)
                ends[found] = ends.get(found, 0.0) + w / math.sqrt(max(n, 1e-30)) * decay ** (at[-1] - at[0] + 1)
        # step[d][node + character]: the node of d + 1 characters, 0 for none; last[node + character]: the weight after the
        # last character. Nodes are numbered by the places where their rows of characters begin.
        wide = len(self.kinds)
        self.step: list[np.ndarray] = []
        nodes: dict[tuple[int, ...], int] = {(): 0}
        for depth in range(1, order):
            below: dict[tuple[int, ...], int] = {}
            table = np.zeros((len(nodes) + 1) * wide, np.int32)
            for found in ends:
                table[nodes[found[: depth - 1]] + found[depth - 1]] = below.setdefault(found[:depth], (len(below) + 1) * wide)
            self.step.append(table)
            nodes = below
        self.last, self.known = np.zeros((len(nodes) + 1) * wide), np.zeros((len(nodes) + 1) * wide, bool)
        for found, w in ends.items():
            self.last[nodes[found[:-1]] + found[-1]] = w
            self.known[nodes[found[:-1]] + found[-1]] = True
        self.code = np.full(int(self.kinds.max(initial=0)) + 2, -1, np.int32)
        self.code[self.kinds] = np.arange(wide)

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of codes the sum, and whether it shares a subsequence with any mark."""
        n, length = s.shape
        code = self.code[np.minimum(s, len(self.code) - 1)].ravel()
        place = np.flatnonzero(code >= 0).astype(np.int32)  # of characters that any mark has, row by row
        code, row = code[place], place // length
        left = np.cumsum(np.bincount(row, minlength=n)).astype(np.int32)[row] - np.arange(1, len(row) + 1, dtype=np.int32)
        here = np.arange(len(place), dtype=np.int32)
        node, first = self.step[0].take(code), place
        for table in [*self.step[1:], None]:
            on = np.flatnonzero(node)
            node, here, first = node[on], here[on], first[on]
            many = left[here]
            # each partial match with each later character of its row
            nxt = np.arange(int(many.sum()), dtype=np.int32) + np.repeat(here + 1 - np.cumsum(many, dtype=np.int32) + many, many)
            at = np.repeat(node, many) + code[nxt]
            if table is None:
                break
            node, here, first = table.take(at), nxt, np.repeat(first, many)
        on = np.flatnonzero(self.known.take(at))
        nxt, at, first = nxt[on], at[on], np.repeat(first, many)[on]
        value = self.last[at] * self.decay ** np.arange(length + 1.0)[place[nxt] - first + 1]
        return np.bincount(row[nxt], value, n), np.bincount(row[nxt], minlength=n) > 0


class Model:
    """Landmarks, the map to features, the separating plane and the logistic curve."""

    def __init__(self, marks: list[str], order: int, decay: float):
        self.marks, self.order, self.decay = marks, order, decay
        value, vector = np.linalg.eigh(kernel(marks, marks, order, decay).astype(float) + 1e-6 * np.eye(len(marks)))
        self.whiten = vector @ np.diag(np.where(value > 0.15, 1 / np.sqrt(np.maximum(value, 0.15)), 0)) @ vector.T  # directions with little in them go
        self.plane, self.bias, self.curve = np.zeros(len(marks)), -1.0, np.array([1.0] + [0.0] * WORST)
        self.sums: Sums | None = None  # made when margins are asked for

    def key(self) -> bytes:
        """What the margins of units depend on."""
        return np.append(self.plane, self.bias).tobytes() + "|".join(self.marks).encode()

    def features(self, units: list[str]) -> np.ndarray:
        return kernel(units, self.marks, self.order, self.decay) @ self.whiten

    def margins(self, units: list[str]) -> np.ndarray:
        """``features`` @ plane + bias; as the plane is linear in the kernels, without the kernel of every mark."""
        out = np.full(len(units), float(self.bias))
        if not units or not self.marks:
            return out
        if self.sums is None:
            self.sums = Sums(self.marks, self.whiten @ self.plane, self.order, self.decay)
        by_length = np.array(sorted(range(len(units)), key=lambda i: len(units[i])))
        for at in range(0, len(units), _ROWS):
            part = by_length[at : at + _ROWS]
            s = _codes([units[i] for i in part.tolist()], max(1, len(units[part[-1]])))
            total, near = self.sums(s)
            row = np.flatnonzero(near)
            if len(row):
                own = _kernel(s[row], np.ascontiguousarray(s[row].T), self.order, self.decay)
                out[part[row]] += total[row] / np.sqrt(np.maximum(own, 1e-30))
        return out

    def fit_plane(self, units: list[str], label: np.ndarray, weight: np.ndarray, cost: float = 10.0, rounds: int = 60) -> None:
        """Dual coordinate descent for the weighted hinge loss."""
        x = np.hstack([self.features(units), np.ones((len(units), 1))])
        y = np.where(label > 0, 1.0, -1.0)
        most, square = cost * weight, (x * x).sum(1)
        alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
        rng = np.random.default_rng(5)
        for _ in range(rounds):
            for i in rng.permutation(len(x)):
                old = alpha[i]
                alpha[i] = min(max(old - (y[i] * (w @ x[i]) - 1) / square[i], 0.0), most[i])
                if alpha[i] != old:
                    w += (alpha[i] - old) * y[i] * x[i]
        self.plane, self.bias, self.sums = w[:-1], float(w[-1]), None

    def fit_curve(self, margins: np.ndarray, label: np.ndarray, rounds: int = 60) -> None:
        """Logistic regression of the label on the worst margins (Newton, slightly pulled to 0); slopes under 0 go."""
        x = np.hstack([np.clip(margins, -2, 1.5), np.ones((len(margins), 1))])
        use = np.ones(x.shape[1], bool)
        while True:
            b = np.zeros(x.shape[1])
            for _ in range(rounds):
                p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
                grad = x[:, use].T @ (p - label) + 1e-2 * b[use]
                hess = (x[:, use] * (p * (1 - p))[:, None]).T @ x[:, use] + 1e-2 * np.eye(int(use.sum()))
                b[use] -= np.linalg.solve(hess, grad)
            wrong = (b < 0) & use & (np.arange(len(b)) < WORST)
            if not wrong.any():
                break
            use &= ~wrong
        self.curve = b

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.clip(margins, -2, 1.5) @ self.curve[:-1] + self.curve[-1], -30, 30)))


def _worst(cache: Cache, batch_texts: list[str], floor: float) -> np.ndarray:
    """Each text's greatest margins of distinct tokens, greatest first; ``floor`` where there are fewer."""
    lists = [t.split() for t in batch_texts]
    lists = [x + spelled(x) for x in lists]
    cache.fill(lists)
    out = np.full((len(lists), WORST), floor)
    for i, tokens in enumerate(lists):
        top = heapq.nlargest(WORST, map(cache.__getitem__, set(tokens)))
        out[i, : len(top)] = top
    return out


def _token_margins(model: Model):
    floor = float(model.bias)

    def work(tokens: list[str]) -> list[float]:
        units = [units_of(t) for t in tokens]
        kinds = sorted({u for us in units for u in us})
        known = dict(zip(kinds, model.margins(kinds).tolist(), strict=True))
        return [known[us[0]] if len(us) == 1 else max((known[u] for u in us), default=floor) for us in units]

    return work


def fit(docs: DataFrame, labels: DataFrame, mod: int = 3, rest: int = 1, train_rows: int = 20_000, landmarks: int = 64, order: int = 4, decay: float = 0.8, unit_rows: int = 6_000, bar: float = 24.0) -> Model:
    """Learn from labelled documents whose crc32(doc_id as text) mod ``mod`` is not ``rest``.

    At most ``train_rows`` labelled documents are used, half of each label at most, chosen by a hash of the id; at most
    ``unit_rows`` units of each kind train the plane. Rows that repeat a doc_id in ``labels`` count as toxic if any is;
    null labels are left out. Without labelled documents of both kinds the model scores everything as clean. A unit marks
    toxic sentences if its evidence passes ``bar``, or is beyond chance and among the strongest ``landmarks`` / 4.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held(F.col("id"), mod, rest))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for kind in (0, 1):
        part = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(train_rows // 2)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(stage(chosen))  # at most train_rows rows
    sample = stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(chosen, F.col("doc_id") == F.col("id")).select("doc_id", "text", "toxic"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Units of labelled sentences, each with a number for the words on either side of it."""
        Cache.use(None)  # the operator before needs its own no more
        for batch in slices(batches):
            found, known = set(), {}

            def look(token: str, known: dict = known) -> tuple[int, list[str]]:
                if token not in known:
                    known[token] = zlib.crc32(token.encode()), units_of(token)
                return known[token]

            for text, toxic in zip(texts(batch), (x > 0 for x in batch.column(2).to_pylist()), strict=True):
                for sentence in _SENTENCE.split(text):
                    tokens = sentence.split()
                    seen = [look(t) for t in tokens]
                    sums = [0, *(x for x, _ in seen), 0]
                    found.update([(u, sums[i] << 31 ^ sums[i + 2], toxic) for i, (_, units) in enumerate(seen) for u in units])
                    found.update([(u, zlib.crc32(sentence.encode()), toxic) for t in spelled(tokens) for u in look(t)[1]])
            cols = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.bool_()), strict=True)], ["unit", "beside", "toxic"])

    # a unit counts once between the same two words, so copies of a sentence add little; what a clean text holds is clean
    contexts = sample.mapInArrow(read, "unit string, beside long, toxic boolean").where(F.length("unit") >= order).groupBy("unit", "beside").agg(F.min(F.col("toxic").cast("int")).alias("toxic"))
    units = stage(contexts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")))
    bad, good = (x or 0 for x in units.agg(F.sum("toxic"), F.sum("clean")).first())
    if not bad or not good:
        return Model([], order, decay)
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (good + 1))
    units = units.withColumn("odds", odds)
    # toxic * odds is about half a likelihood ratio statistic. Chance hardly goes beyond 1 + log(units); edited copies may
    # count again, so more than the strongest few must pass a higher bar
    strength = F.col("toxic") * F.col("odds")
    chance = 1 + math.log(max(1, units.count()))
    marks = units.withColumn("strength", strength).where((F.col("odds") > 1.5) & (F.col("strength") > chance)).orderBy(F.desc("strength"), "unit").limit(unit_rows).collect()
    marks = [r for i, r in enumerate(marks) if i < landmarks // 4 or r["strength"] > bar]
    # landmarks: the strongest marks that are unlike each other
    names: list[str] = []

    def choose(rows: list, most: int) -> None:
        for r in rows:
            if len(names) < most and (not names or kernel([r["unit"]], names, order, decay).max() < 0.5):
                names.append(r["unit"])

    choose(marks[:400], landmarks * 3 // 4)
    if not names:
        return Model([], order, decay)
    sent = list(names)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = kernel(batch.column(0).to_pylist(), sent, order, decay).max(1) if batch.num_rows else np.zeros(0)
            yield batch.filter(pa.array(near > 0.4))

    clean = units.where("odds <= 1.5 and clean > 0").select("unit", "clean")
    close = clean.mapInArrow(alike, "unit string, clean long").orderBy(F.desc("clean"), "unit").limit(unit_rows).collect()
    common = clean.orderBy(F.desc("clean"), "unit").limit(unit_rows // 2).collect()
    others = clean.orderBy(F.xxhash64("unit"), "unit").limit(unit_rows // 2).collect()
    choose(close[:400], landmarks)
    model = Model(names, order, decay)
    rows = {r["unit"]: (r["clean"], 0) for r in [*common, *others, *close]} | {r["unit"]: (r["toxic"], 1) for r in marks}
    weight = np.sqrt(np.array([n for n, _ in rows.values()], float))
    label = np.array([k for _, k in rows.values()])
    weight[label == 1] *= weight[label == 0].sum() / weight[label == 1].sum() / 4
    model.fit_plane(list(rows), label, weight / weight.mean())

    key = model.key()

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(key, model)
        for batch in slices(batches):
            margins = _worst(cache, texts(batch), float(model.bias))
            yield pa.RecordBatch.from_arrays([pa.array(list(margins), pa.list_(pa.float64())), batch.column(2)], ["margins", "toxic"])

    got = sample.mapInArrow(worst, "margins array<double>, toxic int").toArrow()  # four numbers for each of train_rows rows
    model.fit_curve(np.array(got.column("margins").to_pylist()), got.column("toxic").to_numpy().astype(float))
    return model


_caches: dict[bytes, Cache] = {}


def _cache(key: bytes, model: Model) -> Cache:
    """The margins of a model's tokens; one for all tasks of a worker."""
    if key not in _caches:
        _caches.clear()
        _caches[key] = Cache(_token_margins(model), 400_000)
    return _caches[key]


def toxicity(docs: DataFrame, model: Model, mod: int = 3, rest: int = 1, bar: float = 0.7, carry: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= ``bar``), and its row's ``carry``
    (a column of whole numbers).

    Whole texts are read; null and empty texts, and texts without letters or digits, get the score of the model's bias.
    Null ids stay null and count as the text '' in held_out; repeated rows are each scored; an empty table gives no
    rows; other columns are not read. Nothing but the text is an input of the score.
    """
    key = model.key()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = _cache(key, m)
        for batch in slices(batches):
            score = m.score(_worst(cache, texts(batch), float(m.bias)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), batch.column(2)], ["doc_id", "score", "carried"])

    carried = (F.col(carry) if carry else F.lit(None)).cast("long").alias("carried")
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), carried).mapInArrow(run, "doc_id long, score double, carried long")
    more = [F.col("carried").alias(carry)] if carry else []
    return scored.select("doc_id", held(F.col("doc_id"), mod, rest).alias("held_out"), "score", (F.col("score") >= bar).cast("int").alias("predicted"), *more)
