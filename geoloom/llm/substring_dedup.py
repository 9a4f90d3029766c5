"""Removal of repeated passages: winnowed seeds, extended both ways.

Seeds. Of each 50 consecutive words (a window) the winnowing anchor is the k-word gram with the least hash (the last of
equals). Equal windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so a text
gives about 2 anchors per 41 words, each with the run of windows that chose it. Documents are joined on anchors: only
an anchor that occurs in two documents can lie in a repeat.

Extension. Where all runs of an anchor are the same words (64 bits besides those of the anchor), whole runs are repeats: all
but those of the least doc_id go, and no window is looked at. Around each other shared anchor the match is extended over the
windows of its run to the left and to the right: every window is hashed as a whole (96 bits), and the least doc_id that holds it is found by a pre-aggregated count, so no
pairs of documents are made, however many share a passage. Windows first seen in a smaller document merge into maximal
repeats (runs of windows), whose words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import WORD_BYTES, Words, gram_hashes, mix, slices
from geoloom.llm.skew import spread
from geoloom.session import free, stage

#: Bytes of ranges that are sent to every executor at most; beyond it both sides are shuffled.
BROADCAST_BYTES = 32 << 20
#: Turns word hashes into those of the second, 32-bit check on windows.
_OTHER = np.uint64(0x5851F42D4C957F2D)


def window_anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """The place of the least gram (last of equals) in each ``span`` consecutive ones: a sliding minimum by blocks."""
    n = len(grams)
    at = np.arange(n)
    blocks = -(-n // span)
    pad = blocks * span
    value = np.full(pad, np.iinfo(np.uint64).max, np.uint64)
    value[:n] = grams
    place = np.arange(pad)

    grid, spot = value.reshape(blocks, span), place.reshape(blocks, span)
    low_f = np.minimum.accumulate(grid, axis=1)
    at_f = np.maximum.accumulate(np.where(grid == low_f, spot, -1), axis=1)
    rev, rspot = grid[:, ::-1], spot[:, ::-1]
    low_b = np.minimum.accumulate(rev, axis=1)
    # from the right the first place of a minimum is its last place in order
    new = np.ones(rev.shape, bool)
    new[:, 1:] = rev[:, 1:] < low_b[:, :-1]
    held = np.maximum.accumulate(np.where(new, np.arange(span), -1), axis=1)
    at_b = np.take_along_axis(rspot, held, axis=1)
    low_b, at_b = low_b[:, ::-1].reshape(-1), at_b[:, ::-1].reshape(-1)
    low_f, at_f = low_f.reshape(-1), at_f.reshape(-1)
    m = n - span + 1
    i = at[:m]
    j = i + span - 1
    return np.where(low_f[j] <= low_b[i], at_f[j], at_b[i])


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, mark, anchor (hash), run (hash of all its words), first (first window of the run), n (windows in the run).
    docs: doc_id, mark, text."""
    span = window - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            words = Words(batch, lower=False)
            h = words.hashes()
            grams, whole = gram_hashes(h, gram), gram_hashes(h, window)
            rows, hashes, runs, firsts, counts = [], [], [], [], []
            for r in range(words.rows):
                a, b = words.first[r], words.first[r + 1]
                if b - a < window:
                    continue
                g = grams[a : b - gram + 1]
                chosen = window_anchors(g, span)
                begin = np.flatnonzero(np.diff(chosen, prepend=-1))
                rows.append(np.full(len(begin), r))
                hashes.append(g[chosen[begin]])
                n = np.diff(begin, append=len(chosen))
                # the first and the last window cover the run: it has at most ``span`` windows
                runs.append(mix(mix(whole[a + begin]) ^ (whole[a + begin + n - 1] + n.astype(np.uint64))))
                firsts.append(begin)
                counts.append(n)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(np.concatenate(x).view(np.int64)) for x in (hashes, runs)), *(pa.array(np.concatenate(x), pa.int32()) for x in (firsts, counts))],
                    ["doc_id", "mark", "anchor", "run", "first", "n"],
                )

    return docs.mapInArrow(run, "doc_id long, mark long, anchor long, run long, first int, n int")


def _beside(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """docs with the ranges (id, of, runs) of each, if any; the ranges travel whole only while they are few bytes in memory."""
    size = ranges.agg(F.sum(F.size("runs") * 40 + 64)).first()[0] or 0
    return docs.join(F.broadcast(ranges) if size <= BROADCAST_BYTES else ranges.hint("merge"), (docs.doc_id == ranges.id) & (docs.mark == ranges.of), "left")


def _shared(rows: DataFrame, keys: list[str], *more: Column) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows, those of their keys that several doc_ids have (lo: the least; and more), and what to join both on.
    Both are shuffled at every size, so what is shuffled grows as the rows do."""
    groups = stage(rows.groupBy(*keys).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("rows"), *more).where("lo < hi").drop("hi"))
    rows, groups, on = spread(rows, groups, keys, "rows", F.col("doc_id"))
    return rows, groups.drop("rows").hint("merge"), on


def repeats(docs: DataFrame, window: int = 50, gram: int = 10) -> DataFrame:
    """id, of, runs: for each row of ``docs`` (doc_id, mark, text) the runs (first, n) of windows that also start in a row
    with a smaller doc_id. ``of`` is the row's mark, a number for its text, so rows that repeat a doc_id stay apart."""
    anchors = stage(_anchors(docs.where("doc_id is not null"), window, gram))
    rows, shared, on = _shared(anchors, ["anchor"], (F.min("run") == F.max("run")).alias("same"))
    seeds = rows.join(shared, on).where("not same or doc_id > lo")
    sets = [F.collect_set(F.when(w, F.struct("first", "n"))).alias(c) for c, w in (("runs", ~F.col("same")), ("gone", F.col("same")))]
    seeds = stage(seeds.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("of")).agg(*sets))
    free(anchors)
    # where no doc_id repeats, windows need no marks; the ranges get them back from the seeds
    several = not seeds.groupBy("id").count().where("count > 1").isEmpty()

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            words = Words(batch, lower=False)
            h = words.hashes()
            whole, check = gram_hashes(h, window), gram_hashes(mix(h ^ _OTHER), window)
            rows, at = [], []
            for r, runs in enumerate(batch.column(3).to_pylist()):
                size = words.first[r + 1] - words.first[r]
                wanted = np.unique(np.concatenate([np.arange(x["first"], x["first"] + x["n"]) for x in runs]))
                wanted = wanted[wanted <= size - window]
                rows.append(np.full(len(wanted), r))
                at.append(wanted)
            rows, at = np.concatenate(rows), np.concatenate(at)
            place, of = words.first[rows] + at, pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(whole[place].view(np.int64)), pa.array((check[place] >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(at, pa.int32())],
                ["doc_id", "mark", "window", "check", "at"],
            )

    own = F.col("mark") if several else F.lit(0).cast("long")
    wanted = seeds.where("size(runs) > 0").select("id", "of", "runs").hint("merge")
    windows = stage(docs.join(wanted, (docs.doc_id == wanted.id) & (docs.mark == wanted.of)).select("doc_id", own.alias("mark"), "text", "runs").mapInArrow(extend, "doc_id long, mark long, window long, check int, at int"))
    rows, least, on = _shared(windows, ["window", "check"])
    late = rows.join(least, on).where("doc_id > lo").groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("of")).agg(F.collect_set("at").alias("at"))
    late = seeds.select("id", "of", "gone").join(late if several else late.drop("of"), ["id", "of"] if several else "id", "left")
    late = late.where("at is not null or size(gone) > 0").select("id", "of", "at", "gone")

    def maximal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for at, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                at = np.unique(np.concatenate([np.array(at or [], np.int64), *(np.arange(x["first"], x["first"] + x["n"]) for x in gone)]))
                begin = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                runs.append([{"first": int(at[i]), "n": int(n)} for i, n in zip(begin, np.diff(begin, append=len(at)), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])))], ["id", "of", "runs"])

    out = stage(late.mapInArrow(maximal, "id long, of long, runs array<struct<first:int,n:int>>"))
    free(windows, seeds)
    return out


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = 10) -> DataFrame:
    """One row per document: doc_id, mark (a number for its text), n_words, n_removed, kept_text, kept_sha256 (of kept
    words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller doc_id, judged
    on the input. kept_text is null where nothing is removed (the text stays as it is). Null text has no words. Rows
    that repeat a doc_id never count against each other, and each loses only what windows of its own text cover; a row
    with a null doc_id loses nothing and takes nothing. An empty table gives no rows. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("mark"), F.col("text").cast("string"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, gone, kept, sha = [], [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                n.append(len(words))
                if runs:
                    drop = np.zeros(len(words), bool)
                    for x in runs:
                        drop[x["first"] : x["first"] + x["n"] + window - 1] = True
                    words = [w for w, d in zip(words, drop, strict=True) if not d]
                joined = b" ".join(words)
                gone.append(n[-1] - len(words))
                kept.append(joined.decode() if gone[-1] else None)
                sha.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(sha)], ["doc_id", "mark", "n_words", "n_removed", "kept_text", "kept_sha256"]
            )

    both = _beside(docs, repeats(docs, window, gram)).select("doc_id", "text", "runs", "mark")
    return both.mapInArrow(cut, "doc_id long, mark long, n_words long, n_removed long, kept_text string, kept_sha256 string")


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = 10) -> DataFrame:
    """The digest columns of :func:`remove_repeats`: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs, window, gram).drop("kept_text", "mark")


ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), win as (
  select doc_id, i, array_to_string(list_slice(ws, i, i + 49), ' ') as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)
), lo as (
  select g, min(doc_id) as lo from win group by g having min(doc_id) < max(doc_id)
), late as (
  select win.doc_id, list(distinct i) as starts from win join lo on win.g = lo.g where win.doc_id > lo.lo group by win.doc_id
), gone as (
  select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(s, s + 50)) as p from (select doc_id, unnest(starts) as s from late)) group by doc_id
), kept as (
  select w.doc_id, len(ws) as n_words, len(coalesce(ps, [])) as n_removed,
         array_to_string([x[1] for x in list_zip(ws, range(1, len(ws) + 1)) if ps is null or not list_contains(ps, x[2])], ' ') as k
  from w left join gone on gone.doc_id = w.doc_id
)
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed, sha256(coalesce(k, '')) as kept_sha256 from kept
"""
