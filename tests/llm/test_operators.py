"""Operators against brute force, and the edge cases of every one."""

import collections
import hashlib
import os
import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest

import geoloom.llm.near_dedup as near_dedup_module
from geoloom.llm.byte_bpe import decode, encode, round_trip
from geoloom.llm.exact_dedup import exact_dedup
from geoloom.llm.license_scan import TEMPLATES, align, disjoint, license_scan, words_of
from geoloom.llm.lm_score import lm_score
from geoloom.llm.near_dedup import near_dedup, neighbours
from geoloom.llm.packing import pack, solve_patterns
from geoloom.llm.substring_dedup import remove_repeats, substring_dedup
from geoloom.llm.token_counts import token_counts
from geoloom.llm.toxicity import Model, fit, kernel, toxicity
from geoloom.llm.vector_topk import vector_topk

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, kept string, n_tokens string, text_sha256 string, id string, a string, salt string, label string"
SF = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().split()


def corpus(seed=1, n=120):
    """Texts with copies, near copies, shared passages, junk, nulls and empties."""
    r = random.Random(seed)
    vocabulary = [a + b for a in "the an or in st ti on re ß é 日".split() for b in ["", "on", "re", "ti", "!", "ü"]]
    make = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = make(70)
    texts = [None, "", "  \n\t ", "one", "ONE", "don't  stop\n\n x", "a" * 4000, make(20000)]
    while len(texts) < n:
        kind = r.random()
        if kind < 0.15 and len(texts) > 12:
            texts.append(r.choice(texts[8:]))
        elif kind < 0.4 and len(texts) > 12:
            w = (r.choice(texts[8:]) or "").split(" ")
            if w:
                w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w).swapcase() if r.random() < 0.2 else " ".join(w))
        elif kind < 0.55:
            texts.append(make(r.randint(0, 40)) + "\n" + passage + " " + make(r.randint(0, 40)))
        else:
            texts.append(make(r.choice([1, 3, 4, 5, 6, 49, 50, 51, 200])))
    return texts


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x", "x") for i, t in zip(ids, texts, strict=True)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(3).cache()


OPS = {
    "token_counts": lambda d: token_counts(d, P.path("word_bpe_49k.json")),
    "license_scan": license_scan,
    "exact_dedup": exact_dedup,
    "pack": lambda d: pack(d, P.path("byte_bpe_50k.json")),
    "toxicity": lambda d: toxicity(d, Model(["^idiot"], 4, 0.8)),
    "round_trip": lambda d: round_trip(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
    "lm_score": lm_score,
    "substring_dedup": substring_dedup,
    "near_dedup": near_dedup,
}


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, name):
    assert OPS[name](frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPS)
def test_null_ids_and_repeated_rows(spark, name):
    """Nothing fails, and an operator with a row per document returns every row."""
    texts = ["same text here", "same text here", None, "", "x y z", "x y z", "other"]
    got = OPS[name](frame(spark, texts, [7, 7, None, None, 9, 9, None])).collect()
    if name == "pack":
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        assert sum(r["length"] for r in got) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    elif name != "license_scan":
        assert len(got) == len(texts)


def test_token_counts(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in token_counts(docs, P.path("word_bpe_49k.json"), 100).collect():
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)


ODD = ["<|endoftext|>", "a<|startoftext|>é<|endoftext|>́ b", "İstanbul ΑΣ ΟΔΟΣ", "\x1cfoo\x1d bar", "日本語 テキスト", "😀 ok 👨‍👩‍👧", "é  x　y", "don't I'LL we've 's", "1234567 ½ ٣", "a\u0085b\xa0c", "\n\n \n x", "x \n", "end  "]


def test_odd_texts_token_by_token(spark):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    r = random.Random(3)
    pool = "ab \n\té'sİ日1½́ \x1c<|>-😀\xa0　"
    texts = ODD + ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(400)]
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {x["doc_id"]: x["n_tokens"] for x in token_counts(frame(spark, texts), P.path("word_bpe_49k.json")).collect()}
    assert [got[i] for i in range(len(texts))] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = encode(frame(spark, texts), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    ids = {x["doc_id"]: x["ids"] for x in coded.collect()}
    assert [ids[i] for i in range(len(texts))] == [coder.encode_ordinary(t) for t in texts]
    back = {x["doc_id"]: bytes(x["data"]) for x in decode(coded, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()}
    assert [back[i] for i in range(len(texts))] == [t.encode() for t in texts]


def test_round_trip_digests(docs):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in round_trip(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_license_scan(spark):
    texts = [f"some words before {t} and after" for t in TEMPLATES.values()]
    texts += ["Licensed under the apache  license, version 2.0", "This work is now licensed under the GNU General Public License version 3", "a license is a thing", "Permission to speak freely", None, ""]
    got = license_scan(frame(spark, texts)).collect()
    found = {r["doc_id"]: r for r in got}
    for i, name in enumerate(TEMPLATES):
        assert found[i]["license"] == name and found[i]["coverage"] == 1.0 and found[i]["start_word"] == 3
    n = len(TEMPLATES)
    assert found[n]["license"] == "apache-2.0" and found[n + 1]["license"] == "gpl-3.0" and found[n + 1]["coverage"] == 1.0
    assert found[n + 1]["end_word"] - found[n + 1]["start_word"] == 13
    assert set(found) == set(range(n + 2))


def test_license_scan_one_word_edits(spark):
    """Every one-word edit at every place of the short templates, some of the long ones, and scattered insertions, against all alignments."""
    r, texts = random.Random(5), ["Released under an MIT License", "Released a under b the c MIT d License", "the license under the software"]
    for t in TEMPLATES.values():
        w = words_of(t)
        for at in range(len(w)) if len(w) <= 8 else r.sample(range(len(w)), 3):
            for edit in ([*w[:at], "edited", *w[at + 1 :]], [*w[:at], "added", *w[at:]], w[:at] + w[at + 1 :]):
                texts.append(" ".join(["before", *edit, "after"]))
    want = []
    for i, text in enumerate(texts):
        words, found = words_of(text), []
        for name, t in TEMPLATES.items():
            w = words_of(t)
            if 0.8 * len(w) > len(words):
                continue
            for d in range(-len(w), len(words)):
                n, first, end = align(words, w, d, 4)
                if n >= 0.8 * len(w):
                    found.append((name, n / len(w), n, first, end))
        want += [(i, *x) for x in disjoint(found)]
    got = [tuple(x) for x in license_scan(frame(spark, texts)).collect()]
    assert sorted(got) == sorted(want)
    assert {0, 1} <= {x[0] for x in got} and 2 not in {x[0] for x in got}
    edited = {x[0] for x in got}
    assert edited == set(range(len(texts))) - {2}


def test_exact_dedup(docs):
    rows = docs.collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r["text"] or "").encode().translate(LOWER)].append(r["doc_id"])
    got = {r["doc_id"]: r for r in exact_dedup(docs).collect()}
    assert len(got) == len(rows)
    for text, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), i == max(ids), hashlib.sha256(text).hexdigest())


def test_exact_dedup_null_and_repeated_ids(spark):
    """One row of each group stays, whatever its ids."""
    texts = ["same", "SAME", "x", "X", "x", "y", "y", "alone"]
    ids = [None, None, 5, 9, 9, None, 3, None]
    rows = exact_dedup(frame(spark, texts, ids)).collect()
    kept = sorted(((r["keep_id"] is None, r["keep_id"] or 0, r["group_size"]) for r in rows if r["kept"]))
    assert len(rows) == 8 and kept == [(False, 3, 2), (False, 9, 3), (True, 0, 1), (True, 0, 2)]


def test_exact_dedup_long_shared_starts(spark):
    base = "x" * 3000
    texts = [base + c for c in "abca"] + [base, base, base[:32], base[:32], "É", "é"]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup(frame(spark, texts)).collect()}
    assert got == {0: 3, 1: 1, 2: 2, 3: 3, 4: 5, 5: 5, 6: 7, 7: 7, 8: 8, 9: 9}


def check_packing(texts, rows, size=1024):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            part = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_pack(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert check_packing(texts, pack(docs, P.path("byte_bpe_50k.json")).collect()) == 0


def test_pack_one_length(spark):
    texts = ["the cat sat on the mat"] * 700
    assert check_packing(dict(enumerate(texts)), pack(frame(spark, texts), P.path("byte_bpe_50k.json")).collect()) == 0


def test_patterns_fill_exactly():
    """Lengths that were made by parting full sequences."""
    r = np.random.default_rng(2)
    parts = []
    for _ in range(60):
        cuts = np.sort(r.choice(np.arange(1, 1024), r.integers(1, 4), replace=False))
        parts += np.repeat(np.diff([0, *cuts, 1024])[None], 200, 0).ravel().tolist()
    lengths, demand = np.unique(parts, return_counts=True)
    plan = solve_patterns(lengths, demand, 1024)
    used = sum(p * n for p, n in plan)
    assert all((p * lengths).sum() == 1024 for p, _ in plan) and (used <= demand).all()
    assert (used * lengths).sum() > 0.9 * (demand * lengths).sum()


def test_kernel_is_the_subsequence_kernel():
    import itertools

    def brute(s, t, order, decay):
        def feature(x):
            out = collections.Counter()
            for at in itertools.combinations(range(len(x)), order):
                out["".join(x[i] for i in at)] += decay ** (at[-1] - at[0] + 1)
            return out

        a, b = feature(s), feature(t)
        dot = lambda p, q: sum(v * q[k] for k, v in p.items())
        return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5 if a and b else 0.0

    r = random.Random(4)
    units = ["".join(r.choice("abcd") for _ in range(r.randint(1, 9))) for _ in range(40)]
    marks = ["abcd", "aabbcc", "dcbaabcd"]
    got = kernel(units, marks, 3, 0.8)
    for i, u in enumerate(units):
        for j, m in enumerate(marks):
            assert abs(got[i, j] - brute(u, m, 3, 0.8)) < 1e-4


def test_margins_are_those_of_the_features(monkeypatch):
    """And take one kernel for a few thousand units, not one for every landmark."""
    from geoloom.llm import toxicity as module

    r = random.Random(8)
    marks = ["^abcde", "^aabbcc", "^dcbaabcd", "^\u00e9\U0001f600ab\u00e9d"]
    model = module.Model(marks, 4, 0.8)
    model.fit_plane([*marks, "^dead", "^bead", "^cabbage"], np.array([1, 1, 1, 1, 0, 0, 0]), np.ones(7))
    units = ["^" + "".join(r.choice("abcdxy\u00e9\U0001f600") for _ in range(r.randint(0, 24))) for _ in range(300)] + ["^", "xyxy", "^abcde"]
    assert np.abs(model.margins(units) - (model.features(units) @ model.plane + model.bias)).max() < 1e-4
    assert model.margins([]).tolist() == [] and np.ptp(model.margins(["xyxyx", "zz"])) == 0
    calls, plain = [], module._kernel
    monkeypatch.setattr(module, "_kernel", lambda *x: calls.append(1) or plain(*x))
    model.margins(units)
    assert len(calls) <= 1


@pytest.fixture(scope="module")
def toxic(spark):
    """Labelled documents in which some words are insults."""
    r = random.Random(5)
    plain = [a + b for a in "tion heed anre inst thou west barn lamp".split() for b in ["", "ing", "er", "ly", "s", "on"]]
    insults = ["idiot", "moron", "stupid", "scum", "loser"]
    texts, labels = [], []
    for i in range(900):
        w = [r.choice(plain) for _ in range(r.randint(20, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(insults))
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    df = frame(spark, texts)
    return df, fit(df, spark.createDataFrame(labels, "doc_id long, toxic int")), dict(labels)


def test_toxicity_held_out(toxic):
    df, model, labels = toxic
    rows = toxicity(df, model).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxicity_gaps_and_insertions(spark, toxic):
    _, model, _ = toxic
    base = "tion heed anre instly thou westing barns lamp"
    bad = ["i-d-i-o-t m.o.r.o.n", "s t u p i d and m o r o n", "idxiot mooron", "STUPID!!! (moron)", "stuupid sccum"]
    got = {r["doc_id"]: r["score"] for r in toxicity(frame(spark, [f"{base} {b} {base}" for b in bad] + [base, "", None, "!!!"]), model).collect()}
    assert all(got[i] > 0.5 for i in range(len(bad))), got
    assert all(got[i] < 0.3 for i in range(len(bad), len(bad) + 4)), got


def test_toxicity_without_labels(spark, toxic):
    df, _, _ = toxic
    model = fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["predicted"] == 0 for r in toxicity(df.limit(5), model).collect())


def test_lm_score(spark):
    texts = corpus(6, 300)
    tokens = {i: [*(t or "").encode().translate(LOWER).split(), b"\n"] for i, t in enumerate(texts)}
    count = collections.Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(t)
    total, kinds = sum(count.values()), len(count)
    rows = lm_score(frame(spark, texts).repartition(3), block_bytes=20_000).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = tokens[r["doc_id"]]
        base = sum(np.log10((count[w] + 1) / (total + kinds + 1)) for w in t)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, -base)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(count[w] > 0 for w in t), total, zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert max(r["score"] for r in rows) <= 1e-9


def test_lm_score_does_not_depend_on_blocks(spark):
    texts = corpus(7, 200)
    a = {r["doc_id"]: r["score"] for r in lm_score(frame(spark, texts).repartition(1)).collect()}
    b = {r["doc_id"]: r["score"] for r in lm_score(frame(spark, texts).repartition(5), block_bytes=5_000).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 * max(1, abs(a[i])) for i in a)


def brute_scores(tokens, training, divergence=8.0, discount=0.75):
    """log10 probability of each document's tokens by a suffix tree in plain dictionaries."""
    n = [collections.Counter() for _ in range(3)]  # runs of 1, 2 and 3 tokens
    for i in training:
        for k in range(3):
            n[k].update(tuple(tokens[i][j : j + k + 1]) for j in range(len(tokens[i]) - k))
    total, once = sum(n[0].values()), sum(v == 1 for v in n[0].values())
    unknown = max(once, 1) / (total + 1)
    tree = {}
    for k in (1, 2):
        runs = collections.defaultdict(list)
        for run, v in n[k].items():
            if v > 1:
                runs[run[:-1]].append((run, v))
        for ctx, found in runs.items():
            whole = n[k - 1][ctx]
            up = lambda run: n[k - 1][run[1:]] / (total if k == 1 else n[k - 2][run[1:-1]])  # noqa: B023, E731
            rest = whole - sum(v for _, v in found)
            g = sum(2 * v * np.log(v / whole / up(run)) for run, v in found) + 2 * rest * np.log(max(rest, 1) / whole)
            if g > divergence * len(found):
                tree[ctx] = (discount * len(found) + rest) / whole
    out = []
    for t in tokens:
        score = 0.0
        for j, w in enumerate(t):
            p = (1 - unknown) * n[0][(w,)] / total if n[0][(w,)] else unknown
            for k in (1, 2):
                run = tuple(t[j - k : j + 1]) if j >= k else ()
                if run and run[:-1] in tree:
                    v = n[k][run]
                    p = (v - discount if v > 1 else 0) / n[k - 1][run[:-1]] + tree[run[:-1]] * p
            score += np.log10(p)
        out.append(score)
    return out, tree


def test_lm_score_equals_a_plain_suffix_tree(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(names[: rng.choice((6, 60))]) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    texts += [f"{texts[3]} a tail of its own", "one passage that comes twice with words of its own", None, "one passage that comes twice with words of its own", "never seen", ""]
    tokens = [[*(t or "").encode().split(), b"\n"] for t in texts]
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 == 2}
    want, tree = brute_scores(tokens, [i for i in range(len(texts)) if i not in held])
    assert {len(ctx) for ctx in tree} == {1, 2}
    for parts, size in ((1, 1 << 20), (4, 2_000)):
        got = {r["doc_id"]: r["score"] for r in lm_score(frame(spark, texts).repartition(parts), block_bytes=size, bucket_tokens=1_000).collect()}
        assert all(abs(got[i] - w) < 1e-6 * max(1, -w) for i, w in enumerate(want))


def test_lm_score_learns_whatever_comes_twice(spark):
    """A passage that occurs twice is learned however much other text there is."""
    twice = " ".join(f"rare{i}" for i in range(40))
    gains = []
    for size in (50, 2_000):
        texts = [*corpus(9, size), f"{twice} here", f"{twice} there"]
        ids = [i for i in range(len(texts) * 7) if zlib.crc32(str(i).encode()) % 7 != 2][: len(texts)]
        rows = lm_score(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).where(f"doc_id = {ids[-1]}").collect()
        gains.append(rows[0]["score"] - rows[0]["base_score"])
    assert min(gains) > 60, gains


def brute_removed(texts, window=50):
    first = {}
    for i in sorted(texts):
        w = words(texts[i])
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, t in texts.items():
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 8])
def test_substring_dedup(spark, seed):
    texts = dict(enumerate(corpus(seed, 150)))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(frame(spark, list(texts.values())).repartition(3)).collect()}
    assert got == brute_removed(texts)


def test_substring_dedup_repeated_ids(spark):
    """What is cut from one row of an id is not cut from another."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage, "head " + passage, "short text", passage + " tail", None]
    got = sorted((r["n_words"], r["n_removed"]) for r in substring_dedup(frame(spark, texts, [1, 5, 5, None, 5])).collect())
    assert got == [(0, 0), (2, 0), (60, 0), (61, 0), (61, 60)]


def test_copied_runs_need_no_windows(spark, monkeypatch):
    """Where all runs of an anchor are alike they are cut as they are; only at the ends of a passage windows are compared."""
    from geoloom.llm import substring_dedup as S

    r = random.Random(3)
    make = lambda k: " ".join(f"w{r.randrange(10**6)}" for _ in range(k))
    copied, passage = make(900), make(300)
    texts = [copied, make(50) + " " + passage, copied, copied, passage + " " + make(80), make(20) + " " + passage + " " + make(60)]
    rows = []
    monkeypatch.setattr(S, "stage", lambda df, was=S.stage: (lambda out: (rows.append(out.count()) if "window" in out.columns and "at" in out.columns else None, out)[1])(was(df)))
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in S.substring_dedup(frame(spark, texts)).collect()}
    assert got == brute_removed(dict(enumerate(texts)))
    assert len(rows) == 1 and rows[0] < 500


def test_hot_groups_are_split(spark):
    """A passage that every document has, and thousands of equal texts."""
    texts = [f"{i} " + " ".join(f"p{k}" for k in range(55)) for i in range(2500)] + ["equal text"] * 2500
    df = frame(spark, texts)
    got = substring_dedup(df).collect()
    assert all(r["n_removed"] == (55 if 0 < r["doc_id"] < 2500 else 0) for r in got)
    assert sum(r["kept"] for r in exact_dedup(df).collect()) == 2501


def test_untouched_texts_stay(spark):
    got = remove_repeats(frame(spark, ["a  b\n c", None])).collect()
    assert [r["kept_text"] for r in got] == [None, None]


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 9])
def test_near_dedup(spark, seed):
    texts = dict(enumerate(corpus(seed, 200)))
    rows = near_dedup(frame(spark, list(texts.values())).repartition(3)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_dedup_sends_no_pairs_to_the_driver(spark, monkeypatch):
    """Pairs, signatures and shingle sets are merged, however small the planner takes them for."""
    plans, stage = [], near_dedup_module.stage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    monkeypatch.setattr(near_dedup_module, "stage", seen)
    texts = dict(enumerate(corpus(5, 200)))
    rows = near_dedup(frame(spark, list(texts.values()))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts)
    met = [plan for plan in plans if "MapInArrow alike(" in plan or "MapInArrow test(" in plan]
    assert len(met) >= 3  # screened once and confirmed twice; in crowds once more, where rare shingles meet before
    assert all(plan.count("SortMergeJoin") >= 2 for plan in met)
    assert all("BroadcastExchange" not in plan for plan in met[:3])


def test_near_dedup_crowd(spark):
    """Hundreds of near copies of one text, and a passage that unrelated texts share."""
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    texts = []
    for k in range(400):
        if k % 2:
            w = list(base)
            w[r.randrange(150)] = f"v{k}"
        else:
            w = [r.choice(vocabulary) for _ in range(60)] + passage + [r.choice(vocabulary) for _ in range(60)]
        texts.append(" ".join(w))
    rows = near_dedup(frame(spark, texts)).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows} == brute_components(dict(enumerate(texts)))


def test_near_dedup_crowd_under_the_bar(spark):
    """A crowd that shares most of a template, each just under the bar with all others but for planted pairs."""
    r = random.Random(17)
    template = [f"t{i}" for i in range(100)]
    texts = []
    for k in range(1200):
        own = [f"d{k}w{i}" for i in range(r.randint(18, 26))]
        texts.append(" ".join(template + own))
        if k % 15 == 0:  # a partner that shares all but 16 words
            texts.append(" ".join(template + own[:-16] + [f"p{k}w{i}" for i in range(16)]))
    r.shuffle(texts)
    rows = near_dedup(frame(spark, texts).repartition(3)).collect()
    want = brute_components(dict(enumerate(texts)))
    assert 40 <= sum(i != c for i, (_, c) in want.items()) <= 80
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows} == want


def test_near_dedup_form_letters(spark):
    """A form whose letters differ in eight places of their own each: all under the bar, but for those that share five places."""
    r = random.Random(23)
    texts = []

    def letter(places, tag):
        w = [f"t{i}" for i in range(400)]
        for p in places:
            w[p] = f"{tag}x{p}"
        return " ".join(w)

    for k in range(700):
        places = [5 * p for p in r.sample(range(79), 8)]
        texts.append(letter(places, f"d{k}"))
        if k % 10 == 0:
            rest = [5 * p for p in range(79) if 5 * p not in places]
            texts.append(letter(r.sample(places, 5) + r.sample(rest, 3), f"p{k}"))
    r.shuffle(texts)
    rows = near_dedup(frame(spark, texts).repartition(3)).collect()
    want = brute_components(dict(enumerate(texts)))
    assert sum(i != c for i, (_, c) in want.items()) >= 70
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows} == want


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_neighbours_do_not_depend_on_partitions(spark, parts):
    """A row meets the rows just before it, also those of partitions before its own that hold only few; never more of them."""
    rows = [(t, struct.pack(">2I", i // 30, i), i, 0 if i % 5 else i) for t in (0, 1) for i in range(60)]
    want, tight = set(), set()
    for t, label, i, own in rows:
        for d in range(1, 5):
            j = i - d
            if j >= 0 and j // 30 == i // 30:
                if own != (0 if j % 5 else j):
                    want.add((j, i))
                if d == 4:
                    tight |= {(i, t), (j, t)}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        pairs, far = neighbours(spark.createDataFrame(rows, "tree long, label binary, doc_id long, part long"), 2, 4)
        assert {tuple(r) for r in pairs.collect()} == want
        assert {tuple(r) for r in far.collect()} == tight
        labels = spark.createDataFrame([(*r, bytes([r[2] % 2])) for r in rows], "tree long, label binary, doc_id long, part long, sketch binary")
        pairs, _ = neighbours(labels, 2, 4, lambda x, y: (x == y).all(1))
        assert {tuple(r) for r in pairs.collect()} == {(a, b) for a, b in want if a % 2 == b % 2}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_exact_dedup_hot_group_without_ids(spark):
    """A third of all rows are one text without an id: dealt to several tasks, one of them stays."""
    rows = [(None, "Same TEXT")] * 1500 + [(7, "same text")] * 1500 + [(10 + i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup(docs).collect()
    assert len(got) == 6000
    hot = [x for x in got if x["group_size"] > 1]
    assert len(hot) == 3000 and {x["group_size"] for x in hot} == {3000} and {x["keep_id"] for x in hot} == {7}
    assert sum(x["kept"] for x in hot) == 1


def stage_input(spark, rows):
    """Documents with extra columns whose names the stages use as well."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "z", "z") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row int, num string, many string")


@pytest.mark.parametrize("rows", [[], [(5, "head"), (None, None), (5, "")]])
def test_stages_on_small_tables(spark, rows):
    import corpus_pipeline

    for name, step in corpus_pipeline.STAGES:
        docs = stage_input(spark, rows)
        got = step(spark, docs, SF)
        if name == "packing":
            assert got.count() == len(rows)
        else:
            assert got.columns == docs.columns and got.count() == (len(rows) - 1 if name == "exact_dedup" and rows else len(rows))


def test_stages_keep_rows_of_repeated_ids(spark):
    import corpus_pipeline

    steps = dict(corpus_pipeline.STAGES)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = stage_input(spark, [(1, passage), (5, "head " + passage), (5, "an unrelated short text of its own"), (None, passage)])
    got = {(r["doc_id"], r["text"]) for r in steps["substring_dedup"](spark, docs, SF).collect()}
    assert got == {(1, passage), (5, "head"), (5, "an unrelated short text of its own"), (None, passage)}
    docs = stage_input(spark, [(5, "same text"), (9, "same text"), (5, "only copy of this other text"), (None, "lost"), (None, "LOST"), (7, "twin"), (7, "twin")])
    got = sorted(((r["doc_id"] or 0, r["text"].lower()) for r in steps["exact_dedup"](spark, docs, SF).collect()))
    assert got == [(0, "lost"), (5, "only copy of this other text"), (7, "twin"), (9, "same text")]
    near = passage.replace("p59", "q")
    docs = stage_input(spark, [(5, passage), (5, near), (3, near + " z"), (5, "only copy of this other text"), (None, "lost"), (None, passage)])
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in steps["near_dedup"](spark, docs, SF).collect()))
    assert got == [(0, "lost"), (3, near + " z"), (5, "only copy of this other text")]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = steps["toxicity"](spark, docs, SF)
    toxic = docs.join(kept, "doc_id", "left_anti").select("doc_id").first()[0]
    more = docs.limit(1).selectExpr(f"cast({toxic} as bigint) as doc_id", "'a clean text of its own' as text", *docs.columns[2:])
    got = [r["text"] for r in steps["toxicity"](spark, docs.union(more), SF).where(f"doc_id = {toxic}").collect()]
    assert got == ["a clean text of its own"]


def brute_topk(vectors, k, every):
    ints = {i: [int(np.floor(64.0 * float(np.float32(x)))) for x in v] for i, v in vectors.items() if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q, a in ints.items():
        if q % every == 0:
            score = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints.items() if i != q))[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(score, 1)}
    return out


@pytest.mark.parametrize("n, dim, scale", [(400, 8, 1.0), (60, 64, 0.1), (15, 4, 1e6)])
def test_vector_topk(spark, n, dim, scale):
    r = np.random.default_rng(n)
    vectors = {i: [float(np.float32(x)) for x in r.normal(0, scale, dim)] for i in range(n)}
    vectors[3] = vectors[2]  # ties
    vectors |= {n: None, n + 1: [None] * dim, n + 2: [float("nan")] * dim, n + 3: [float("inf")] * dim, n + 4: []}
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in vectors.items()], "vec_id long, embedding array<float>, score string, rank string")
    got = {tuple(x) for x in vector_topk(df, 20, 5, chunk_rows=64, block_rows=16).collect()}
    assert got == brute_topk(vectors, 20, 5)


def test_vector_topk_huge(spark):
    """Components beyond 64 bits beside ordinary ones: scores that fit are exact, others end at 64 bits."""
    vectors = {0: [1e30, 1.0], 1: [1e30, -1.0], 2: [0.0, 3.0], 3: [1e-3, 2.0], 4: [1.0, 1e8], 5: [3.0, 1.0], 10: [1.0, 1.0], 15: [1e12, -1e12]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {tuple(x) for x in vector_topk(df, 20, 5, chunk_rows=3, block_rows=2).collect()}
    ints = {i: [int(np.floor(64.0 * x)) for x in v] for i, v in vectors.items()}
    want = set()
    for q in (i for i in ints if i % 5 == 0):
        score = {i: sum(x * y for x, y in zip(ints[q], v)) for i, v in ints.items() if i != q}
        cut = {i: min(max(s, -(2**63)), 2**63 - 1) for i, s in score.items()}
        want |= {(q, n, i, cut[i]) for n, i in enumerate(sorted(cut, key=lambda i: (-cut[i], i)), 1)}
    assert got == want


def test_vector_topk_sends_no_blocks_to_the_driver(spark):
    """Blocks are there once for every chunk when they meet the chunks; files of a hundredth of that must not count as small."""
    r = np.random.default_rng(3)
    vectors = {i: [float(np.float32(x)) for x in r.normal(0, 1, 4)] for i in range(90)}
    found = vector_topk(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>"), 5, 3, chunk_rows=8, block_rows=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {tuple(x) for x in found.collect()} == brute_topk(vectors, 5, 3)


def test_vector_topk_empty(spark):
    assert vector_topk(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark, tmp_path):
    """Each stage against what it should keep, judged on its own input."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        step(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if name == "packing":
            assert check_packing(before, after) == 0
            continue
        assert docs.columns == columns
        kept = {r["doc_id"]: r["text"] for r in after}
        if name == "exact_dedup":
            best = {}
            for i, t in before.items():
                key = (t or "").encode().translate(LOWER)
                best[key] = max(i, best.get(key, i))
            assert set(kept) == set(best.values())
        elif name == "near_dedup":
            assert set(kept) == {i for i, (_, c) in brute_components(before).items() if c == i}
        elif name == "substring_dedup":
            want = brute_removed(before)
            assert set(kept) == set(before)
            for i, t in kept.items():
                assert (t == before[i]) if not want[i][1] else hashlib.sha256(t.encode()).hexdigest() == want[i][2]
        else:
            assert len(kept) >= 0.8 * len(before)
