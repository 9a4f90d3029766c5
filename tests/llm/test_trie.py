"""op11 against a trie in dictionaries."""

import hashlib
import math
import random
import re
import zlib

import pytest

from geoloom.llm import prefix_trie as P

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            ident = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), ident, (role, text)))
    own = {c: [t for *_, t in sorted(x)] for c, x in convs.items()}
    built = {c: own.get(c - int(math.fmod(c, 20)), [])[: zlib.crc32(str(c).encode()) % 4] + x[zlib.crc32(str(c).encode()) % 4 :] for c, x in own.items()}
    nodes = {}
    for c, x in built.items():
        for d in range(len(x) + 1):
            nodes.setdefault(tuple(x[:d]), []).append(c)
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    totals = {}
    for k in sorted(nodes, key=len, reverse=True):
        saved = (len(nodes[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        totals[k] = (sum(totals[x][0] for x in kids.get(k, ())) or 1, saved + sum(totals[x][1] for x in kids.get(k, ())))
    return sorted(
        (min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids.get(k, ())), totals[k][0], totals[k][1], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)).encode()).hexdigest())
        for k, m in nodes.items()
    )


def found(spark, rows, kind=KIND):
    got = P.conversation_trie(spark.createDataFrame(rows, kind))
    assert got.columns == list(P._NODE)
    return sorted(map(tuple, got.collect()))


def crowd(seed, n, turns=6, words=4):
    """Conversations over few turns, so that they share a lot; a third are one conversation, one is long."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        if rng.random() < 0.3:
            said = ["hello there", "fine", "bye"]
        else:
            said = ["hello there"] * (rng.random() < 0.6) + [" ".join(rng.choice("abc") for _ in range(rng.randrange(words))) for _ in range(rng.randrange(turns))]
        rows += [(c if c % 7 else c - 40, t, "user" if t % 2 else None, s) for t, s in enumerate(said)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_dictionaries(spark, seed, monkeypatch):
    rows = crowd(seed, 150)
    rows += [(1000, t, "user", f"turn {t % 50}") for t in range(120)] + [(1001, t, "user", f"turn {t % 50}") for t in range(119)] + [(1001, 119, "user", "end")]
    assert found(spark, rows) == brute(rows)


def test_small_slices_recombine(spark):
    """Slices of a few cells: every node on a border is put together again."""
    rows = crowd(9, 90)
    seqs = [(c, [(h, w) for h, w in s]) for c, s in _built(rows).items()]
    want = brute(rows)
    for cells in (1, 7, 40):
        assert _local(seqs, cells) == {(d, c, n, k, l, s) for c, d, _, n, k, l, s, _ in want}


def _built(rows):
    own = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        own.setdefault(c, []).append((turn, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), len(text.split())))
    own = {c: [(i, w) for _, i, w in sorted(x)] for c, x in own.items()}
    return {c: own.get(c - int(math.fmod(c, 20)), [])[: zlib.crc32(str(c).encode()) % 4] + x[zlib.crc32(str(c).encode()) % 4 :] for c, x in own.items()}


def _local(seqs, cells):
    """All parts of one partition, added up by key."""
    rows = sorted((P._Row(c, b"".join(h for h, _ in s), [w for _, w in s], False) for c, s in seqs), key=lambda r: (r.seq, r.conv))
    out, open_, before, held = set(), {}, None, []
    batches = []
    for r in [*rows, None]:
        if held and (r is None or max(x.depth for x in [*held, r]) * (len(held) + 1) > cells):
            batches += P.slice_parts(held, before, r, 0)
            before, held = held[-1], []
        held.append(r)
    for b in batches:
        for x in b.to_pylist():
            if x["kind"] == "node":
                out.add((x["depth"], x["conv_id"], x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"]))
            elif x["kind"] == "open":
                had = open_.setdefault(x["key"], [x["depth"], x["conv_id"], 0, 0, 0, 0])
                had[1] = min(had[1], x["conv_id"])
                for i, k in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens")):
                    had[2 + i] += x[k]
    return out | {tuple(x) for x in open_.values()}


def test_odd_rows(spark):
    kind = "conv_id long, turn long, role string, text string, depth string, key int"
    rows = [(None, 0, "user", "lost", "x", 1), (3, None, None, None, "x", 1), (3, 0, "user", "a b", None, 2), (3, 0, "user", "a b", "x", 2), (3, 1, "", "x " * 30000, "y", 3), (25, 0, "user", "only", "z", 1), (23, 5, "assistant", "é　ß", "z", 1), (20, 0, "user", "a b", "z", 1)]
    assert found(spark, rows, kind) == brute(rows)
    assert found(spark, [], KIND) == []
    assert found(spark, [(None, 1, "user", "x")], KIND) == []
    assert found(spark, [(25, 0, "user", "gone")]) == brute([(25, 0, "user", "gone")])


def test_one_conversation_many_times(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 8000, 5) for t in range(3)]
    assert found(spark, rows) == brute(rows)
