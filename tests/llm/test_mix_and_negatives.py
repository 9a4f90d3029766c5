"""op12 and op13 against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from geoloom.llm import hard_negatives as H
from geoloom.llm import mixing as M

# -- op13 --------------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, size int, target string"


def targets(sizes):
    """Shared out by weight again and again until none is above its room."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [k for k in sizes if k is None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[k] for k in full)
        level = left / max(sum(weight[k] for k in names if k not in full), 1)
        over = {k for k in names if k not in full and weight[k] * level > 2 * sizes[k]}
        if not over:
            return {k: 2.0 * sizes[k] if k in full else weight[k] * level for k in names}
        full |= over


def documents(seed, n):
    rng, rows = random.Random(seed), []
    for i in range(n):
        source = "big" if rng.random() < 0.4 else rng.choice(["a", "B", "é", "", None, "zz", "￿", "\U0001f600"])
        rows.append((i, None if rng.random() < 0.05 else " \t".join("w" for _ in range(int(rng.expovariate(0.05)))), source, 3, "x"))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_mix_meets_its_targets(spark, seed):
    rows = documents(seed, 1500)
    sizes, biggest = Counter(), Counter()
    for _, text, source, *_ in rows:
        words = len((text or "").split())
        sizes[source] += words
        biggest[source] = max(biggest[source], words)
    want, source_of = targets(sizes), {r[0]: r[2] for r in rows}
    got = M.mix_plan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and math.isclose(r.target, want[source], rel_tol=1e-12)
        expected = r.target / max(r.source_size, 1)
        assert r.taken == r.copies * r.size and math.floor(expected - 1e-6) <= r.copies <= math.ceil(expected) <= 2
        taken[source] += r.taken
    assert all(abs(taken[k] - want[k]) <= max(biggest[k], 1) for k in want)
    assert math.isclose(sum(want.values()), 1.5 * sum(sizes.values()))


def test_mix_is_the_same_however_rows_are_dealt(spark):
    rows = documents(5, 600)
    one = M.mix_plan(spark.createDataFrame(rows, DOCS).coalesce(1))
    many = M.mix_plan(spark.createDataFrame(rows[::-1], DOCS).repartition(7))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_mix_odd_rows(spark):
    rows = [(1, "a b", "x", 1, "t"), (1, "a b", "x", 1, "t"), (None, "c", None, 1, "t"), (None, None, None, 1, None), (2, "", "y", None, None), (3, "w " * 100_000, "x", 0, "t")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(M.mix_plan(docs).collect(), key=str)
    assert [r.size for r in got if r.doc_id == 3] == [100_000] and len(got) == 6
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: n for k, n in _copies(got).items() if n})
    assert M.mix_plan(docs.limit(0)).collect() == [] and M.mix(docs.limit(0)).collect() == []
    empty = spark.createDataFrame([(1, None, "x", 1, ""), (2, " ", None, 1, "")], DOCS)
    assert all(r.target == 0 and r.taken == 0 for r in M.mix_plan(empty).collect())


def _copies(plan):
    out = Counter()
    for r in plan:
        out[r.doc_id] += r.copies
    return out


def test_mix_is_native(spark):
    plan = M.mix_plan(spark.createDataFrame(documents(1, 50), DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- op12 --------------------------------------------------------------------------------------------------------------


def brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v])
        kept[i] = min(kept.get(i, one), one)
    longs = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for a, (label, v) in kept.items():
        if a % 50:
            continue
        score = {b: longs(sum(x * y for x, y in zip(v, w, strict=False))) for b, (_, w) in kept.items() if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if kept[b][0] == label][:5]:
            fit = [b for b in order if kept[b][0] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out += [(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(fit[:3])]
    return sorted(out)


def mined(spark, rows, **how):
    got = H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string"), **how)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def cloud(seed, n, dim=6, hot=0.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, dim))
    rows = []
    for i in range(n):
        k = int(rng.integers(4))
        v = centre[0] if rng.random() < hot else centre[k] + 0.2 * rng.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)), "x"))
    return rows


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_negatives_equal_brute_force(spark, hot):
    rows = cloud(3, 900, hot=hot)
    assert mined(spark, rows, chunk_rows=200, block_rows=8) == brute([r[:3] for r in rows])


def test_negatives_odd_rows(spark):
    rows = cloud(4, 260, dim=3)
    rows += [(None, [1.0, 1.0, 1.0], 1, "x"), (300, None, 1, "x"), (350, [1.0, None, 1.0], 1, "x"), (400, [1.0, float("nan"), 0.0], 1, "x"), (450, [float("inf"), 0.0, 0.0], 1, "x"), (500, [1.0, 1.0, 1.0], None, "x")]
    rows += [(550, [1.0], 2, "x"), (600, [], 2, "x"), (650, [1.0, 2.0, 3.0, 4.0], 2, "x"), (50, [0.5, 0.5, 0.5], 0, "again"), (50, [0.5, 0.5, 0.5], 0, "again"), (51, [-9.0, 1.0, 1.0], 0, "again")]
    assert mined(spark, rows, chunk_rows=64, block_rows=4) == brute([r[:3] for r in rows])
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1, "alone")]) == []


def test_negatives_huge_values(spark):
    rows = [(i, [1e8 * (i % 5), -3e7, float(i)], i % 3, "x") for i in range(0, 120, 2)]
    assert mined(spark, rows, chunk_rows=16) == brute([r[:3] for r in rows])
    rows = [(i, [1e30, (-1.0) ** i * i], i % 3, "x") for i in range(0, 120, 5)]
    assert mined(spark, rows) == brute([r[:3] for r in rows])


def test_str_tree_boxes_hold_their_rows():
    x = np.random.default_rng(0).integers(-50, 50, (1000, 5)).astype(float)
    x = x[H.str_order(x)]
    low, high = H.boxes(x)[0]
    assert all((x[i : i + H.PAGE] >= a).all() and (x[i : i + H.PAGE] <= b).all() for i, a, b in zip(range(0, 1000, H.PAGE), low, high, strict=True))
    q = np.random.default_rng(1).integers(-9, 9, (7, 5)).astype(float)
    under, over = H.bounds(q, low, high)
    exact = q @ x.T
    for j, i in enumerate(range(0, 1000, H.PAGE)):
        assert (exact[:, i : i + H.PAGE].min(1) >= under[:, j]).all() and (exact[:, i : i + H.PAGE].max(1) <= over[:, j]).all()


