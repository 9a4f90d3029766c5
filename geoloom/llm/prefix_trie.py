"""Prefix trie of conversations, aggregated at every depth from sorted turn-id matrices.

Conversations are dealt out by ranges of their turn sequences and sorted, so those that start alike are neighbours. A
slice of neighbours becomes a padded matrix of turn ids, a row for each conversation. Where a row differs from the one
before it in a column or in any earlier one (changes OR-accumulated along the row), a node starts; sums and least
values between the starts (``reduceat``) aggregate every depth. Everything a node reports is a sum over its
members, because a word is saved once for every turn that a row shares with the row before it:

    saved(node) = sum over members of the words of the turns from the node's depth to the shared length
    children(node) = members that start a node one deeper, leaves(node) = members after which nothing goes on

Only nodes on the first and last row's paths of a slice can go on in another slice. They leave the task as parts and are
added up by a digest of their turns; what a partition's first row shares with the last row of the partition before
it is corrected by further parts, a few for each partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.session import stage

#: A slice's matrix has at most so many cells (a longer row is a slice of its own); blobs of ids hold at most so many.
CELLS, BLOB = 1 << 20, 1000
_ID = 16  # bytes of a turn id
_EMPTY = hashlib.sha256(b"").hexdigest()

_PART = "kind string, part int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary, ends_sha256 string, more boolean, words binary"
_FIELDS = [(f.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[f.split()[1]]) for f in _PART.split(", ")]
_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in _FIELDS], [k for k, _ in _FIELDS])


def _key(seq: bytes, depth: int) -> bytes:
    return hashlib.md5(seq[: _ID * depth]).digest()


class _Row:
    """One conversation: its id, its turn ids end to end, sums of words up to each turn, and whether turns follow that are
    its own alone."""

    def __init__(self, conv: int, seq: bytes, words: list[int], more: bool):
        self.conv, self.seq, self.more, self.depth = conv, seq, more, len(words)
        self.words = np.zeros(len(words) + 1, np.int64)
        np.cumsum(words, out=self.words[1:])

    def shared(self, other: _Row | None) -> int:
        """How many leading turns both have."""
        if other is None:
            return 0
        n = min(self.depth, other.depth)
        a, b = (np.frombuffer(x.seq[: n * _ID], np.uint64).reshape(n, 2) for x in (self, other))
        unlike = (a != b).any(1)
        return int(unlike.argmax()) if unlike.any() else n


def slice_parts(rows: list[_Row], before: _Row | None, after: _Row | None, part: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a sorted slice, whole ones ("node") and parts ("open", with "ends" of ids), given the neighbour rows of
    the same partition."""
    n, width = len(rows), max(r.depth for r in rows)
    depth = np.array([r.depth for r in rows])
    conv = np.array([r.conv for r in rows], np.int64)
    more = np.array([r.more for r in rows])
    flat = np.frombuffer(b"".join(r.seq for r in rows), f"S{_ID}")
    inside = np.arange(width) < depth[:, None]
    turns = np.full((n, width), -1, np.int32)
    turns[inside] = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    sums = np.zeros((n, width + 1), np.int64)
    for i, r in enumerate(rows):
        sums[i, : r.depth + 1] = r.words
    order = np.lexsort([conv, *turns.T[::-1]])
    turns, depth, conv, more, sums = turns[order], depth[order], conv[order], more[order], sums[order]
    first, last = rows[order[0]], rows[order[-1]]
    changed = np.zeros((n, width), bool)
    changed[1:] = turns[1:] != turns[:-1]
    changed[0] = True
    changed[0, : first.shared(before)] = False
    started = np.logical_or.accumulate(changed, axis=1)
    shared = (~started & (turns >= 0)).sum(1)
    leaf = np.ones(n, np.int64)
    leaf[:-1] = more[:-1] | (shared[1:] < depth[:-1])
    if after is not None:
        leaf[-1] = more[-1] | (after.shared(last) < depth[-1])
    full = np.where(more, depth + 1, depth)  # a row with own turns goes on below its last column
    upper_least, upper_of, upper_open = None, None, None
    for d in range(width + 1):
        at = np.flatnonzero(depth >= d)
        if not len(at):
            break
        begins = started[at, d - 1].copy() if d else np.zeros(len(at), bool)
        begins[0] = True
        heads = np.flatnonzero(begins)
        of = np.cumsum(begins) - 1
        least = np.minimum.reduceat(conv[at], heads)
        d_shared, reach = shared[at], sums[at, shared[at]] - sums[at, max(d, 1) - 1]
        saved = np.add.reduceat(np.where(d_shared >= max(d, 1), reach, 0), heads)
        children = np.add.reduceat(((d_shared <= d) & (full[at] > d)).astype(np.int64), heads)
        leaves, members = np.add.reduceat(leaf[at], heads), np.diff(np.append(heads, len(at)))
        is_open = np.zeros(len(heads), bool)
        is_open[0], is_open[-1] = is_open[0] or at[0] == 0, is_open[-1] or at[-1] == n - 1
        ended = np.flatnonzero((depth[at] == d) & ~more[at])
        texts: list[list[str]] = [[] for _ in heads]
        for i in ended:
            texts[of[i]].append(str(conv[at[i]]))
        if d:
            of_above = upper_of[at[heads]]
            parents = upper_least[of_above]
        nodes = np.flatnonzero(~is_open)
        if len(nodes):
            under = upper_open[of_above[nodes]]
            heads_at = at[heads[nodes]]
            key_of = [_key(rows[order[i]].seq, d - 1) if u else None for i, u in zip(heads_at, under, strict=True)]
            yield _batch(
                kind=["node"] * len(nodes), depth=np.full(len(nodes), d), parent_key=key_of, conv_id=least[nodes], parent_conv_id=[None if u else p for u, p in zip(under, parents[nodes], strict=True)],
                n_convs=members[nodes], n_children=children[nodes], n_leaves=leaves[nodes], saved_tokens=saved[nodes], ends_sha256=[hashlib.sha256(",".join(texts[j]).encode()).hexdigest() for j in nodes],
            )
        for j in np.flatnonzero(is_open):
            seq = rows[order[at[heads[j]]]].seq
            key, above = _key(seq, d), _key(seq, d - 1) if d else None
            yield _batch(kind=["open"], depth=[d], key=[key], parent_key=[above], conv_id=[least[j]], n_convs=[members[j]], n_children=[children[j]], n_leaves=[leaves[j]], saved_tokens=[saved[j]])
            ids = conv[at[ended[of[ended] == j]]]
            blobs = [ids[i : i + BLOB] for i in range(0, len(ids), BLOB)]
            if blobs:
                yield _batch(kind=["ends"] * len(blobs), key=[key] * len(blobs), conv_id=[b[0] for b in blobs], ends=[b.tobytes() for b in blobs])
        upper_of = np.full(n, -1)
        upper_of[at] = of
        upper_least, upper_open = least, is_open


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[_Row]:
    for batch in batches:
        for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
            for conv, seq, words, more in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                yield _Row(conv, seq, words, more)


def trie_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All parts of a sorted partition of (conv_id, seq, words, more), and its first and last row ("edge")."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    before, held, width, edges = None, [], 0, []
    for row in _rows(batches):
        if held and max(width, row.depth, 1) * (len(held) + 1) > CELLS:
            yield from slice_parts(held, before, row, part)
            before, held, width = held[-1], [], 0
        if not edges:
            edges.append(row)
        held.append(row)
        width = max(width, row.depth)
    if held:
        yield from slice_parts(held, before, None, part)
        for kind, r in (("first", edges[0]), ("last", held[-1])):
            yield _batch(kind=[kind], part=[part], key=[r.seq], conv_id=[r.conv], more=[r.more], words=[r.words.tobytes()])


def _seam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What changes where a partition's first row meets the last row of the partition before it: further parts."""
    for batch in batches:
        for x in batch.to_pylist():
            now, last = np.frombuffer(x["words"], np.int64), np.frombuffer(x["last_words"], np.int64)
            a, b = _Row(0, x["key"], [0] * (len(now) - 1), False), _Row(0, x["last_key"], [0] * (len(last) - 1), False)
            same = a.shared(b)
            over = not x["last_more"] and same == b.depth  # the last row's node goes on, so it was no leaf
            for d in range(same + 1):
                saved = int(now[same] - now[max(d, 1) - 1]) if same >= max(d, 1) else 0
                yield _batch(kind=["open"], depth=[d], key=[_key(x["key"], d)], parent_key=[_key(x["key"], d - 1) if d else None], n_convs=[0], n_children=[-1 if d < same else 0], n_leaves=[-1 if over else 0], saved_tokens=[saved])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest for each key of blobs that come sorted by (key, first id); nothing is held but its state."""
    key, state = None, None
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "sha": [state.hexdigest()]})
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, np.frombuffer(blob, np.int64).tolist())).encode())
    if state is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "sha": [state.hexdigest()]})


def rebuilt_turns(turns: DataFrame, every: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, id, words) of all turns of the rebuilt conversations, and (conv_id) of all conversations; both staged.

    Conversation c has h = crc32(c) % ``shared`` turns of conversation c - c % ``every`` in place of its own first h
    (% has the sign of c, as in SQL).
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    role, said = text(F.col("role")), text(F.col("text"))
    ident = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, said)))
    plain = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), ident.alias("id"), F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    dealt = stage(plain.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    # places grow along the whole order, with gaps between partitions: a conversation over several needs its partitions' rows
    part = F.shiftright("at", 33)
    runs = dealt.groupBy("conv_id", part.alias("part")).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select("conv_id", "part", "low", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("done")))
    own = dealt.withColumn("part", part).join(runs.select("conv_id", "part", "low", "done"), ["conv_id", "part"])
    own = stage(own.select("conv_id", (F.col("at") - F.col("low") + F.col("done") + 1).alias("pos"), "id", "words"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(shared))
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = stage(runs.groupBy("conv_id").agg(F.sum("n").alias("n")).select("conv_id", "n", taken.alias("h"), base.alias("base")))
    heads = own.where((F.col("pos") < shared) & (F.col("conv_id") % every == 0))
    asked = convs.where("h > 0").select("conv_id", "h", "base")
    given = asked.join(heads.select(F.col("conv_id").alias("base"), "pos", "id", "words"), "base").where("pos <= h").select("conv_id", "pos", "id", "words")
    lent = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    shift = asked.join(lent, "base", "left").select("conv_id", F.col("h"), F.least(F.col("h"), F.coalesce("n_base", F.lit(0))).alias("got"))
    moved = own.where(F.col("pos") > taken).join(shift, "conv_id", "left")
    kept = moved.select("conv_id", (F.col("pos") - F.coalesce(F.col("h") - F.col("got"), F.lit(0))).alias("pos"), "id", "words")
    return stage(given.unionByName(kept)), convs.select("conv_id")


def prefix_trie(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct sequence of leading turns: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    sequences: conv_id, pos (1, 2, ...), id (16 bytes that stand for the turn), words. convs: conv_id of all conversations,
    those without turns too. From the first turn that no other conversation has at that place, a conversation is alone;
    the nodes below it need no matrix and are made row by row, so however long a conversation is, only what it shares is
    ever gathered into one row.
    """
    single = sequences.groupBy("pos", "id").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1")
    alone = stage(single.groupBy("conv_id").agg(F.min("pos").alias("alone_at")))
    known = stage(sequences.join(alone, "conv_id", "left"))
    upper = known.where("alone_at is null or pos <= alone_at").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("t"))
    ends = known.groupBy("conv_id").agg(F.max("pos").alias("len"), F.max("alone_at").alias("alone_at"))
    seq = F.unhex(F.coalesce(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), ""), F.lit("")))
    words = F.coalesce(F.transform("t", lambda x: x["words"]), F.array().cast("array<bigint>"))
    rows = convs.join(ends, "conv_id", "left").join(upper, "conv_id", "left").select("conv_id", seq.alias("seq"), words.alias("words"), F.coalesce(F.col("len") > F.col("alone_at"), F.lit(False)).alias("more"))
    order = ["seq", "conv_id"]
    parts = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(trie_parts, _PART))

    near = Window.orderBy("part")  # one row for each partition
    lasts = parts.where("kind = 'last'").select(F.col("part"), F.col("key").alias("k"), F.col("more").alias("m"), F.col("words").alias("w"))
    edge = parts.where("kind = 'first'").select("part", "key", "words").join(lasts, "part")
    seams = edge.select("part", "key", "words", *[F.lag(c).over(near).alias(f"last_{n}") for c, n in (("k", "key"), ("w", "words"), ("m", "more"))]).where("last_key is not null")
    opened = parts.where("kind = 'open'").unionByName(seams.mapInArrow(_seam, _PART))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    opened = stage(opened.groupBy("key").agg(F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums))
    blobs = parts.where("kind = 'ends'").select("key", "ends", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
    hashed = blobs.mapInArrow(_hash_ends, "key binary, sha string")
    least = opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top"))
    nodes = parts.where("kind = 'node'").join(least, "parent_key", "left").select("conv_id", "depth", F.coalesce("parent_conv_id", "top").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    whole = opened.join(hashed, "key", "left").join(least, "parent_key", "left").select("conv_id", "depth", F.col("top").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"))

    long = lambda v: F.lit(v).cast("long")
    length = ends.where("len > alone_at").select("conv_id", "len")
    own = known.where("pos > alone_at").select("conv_id", "pos").join(length, "conv_id")
    last = F.col("pos") == F.col("len")
    tails = own.select(
        "conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"), long(1).alias("n_convs"), F.when(last, long(0)).otherwise(long(1)).alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return nodes.unionByName(whole).unionByName(tails).select(*_NODE)


def conversation_trie(turns: DataFrame, every: int = 20, shared: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text); see :func:`rebuilt_turns`.

    A null role or text is empty. Turns go by turn number, null first; of equal numbers by a digest of role and text. Rows
    without a conv_id take no part. Repeated rows are turns of their own. Rebuilt conversations without turns are
    members of the root only. No conversations give no rows, not even a root. Other columns are not read.
    """
    return prefix_trie(*rebuilt_turns(turns, every, shared))


#: crc32 step by step: a byte is mixed in, then eight shifts (marked -1) follow.
_CRC = "xor(list_reduce(list_prepend(4294967295, flatten([[ascii(substr(s, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1] for i in range(1, len(s) + 1)])::bigint[]), lambda c, e: case when e >= 0 then xor(c, e) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295)"
ORACLE = rf"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null
), o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, md5(octet_length(encode(role)) || ':' || role || text)) as pos from t
), c as (
  select conv_id, n, {_CRC} % 4 as h from (select conv_id, count(*) as n, cast(conv_id as varchar) as s from o group by conv_id)
), b as (
  select c.conv_id, pos, role, text from c join o on o.conv_id = c.conv_id - c.conv_id % 20 and pos <= h
  union all
  select c.conv_id, pos - c.h + least(c.h, coalesce(z.n, 0)), role, text from c join o on o.conv_id = c.conv_id and pos > c.h left join c z on z.conv_id = c.conv_id - c.conv_id % 20
), p as (
  select conv_id, pos as depth, md5(to_json(list({{'r': role, 't': text}}) over w)::varchar) as key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from b window w as (partition by conv_id order by pos)
  union all
  select conv_id, 0, 'root', 0 from c
), l as (
  select *, lag(key) over (partition by conv_id order by depth) as parent, lead(key) over (partition by conv_id order by depth) is null as ended from p
), n as (
  select key, any_value(depth) as depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ended), '')) as ends_sha256 from l group by key
), k as (
  select parent as key, count(*) as n_children from n where parent is not null group by parent
), f as (
  select n.*, coalesce(n_children, 0) as n_children from n left join k using (key)
), s as (
  select p.key, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum((n_convs - 1) * f.words) as saved from f join p on p.conv_id = f.conv_id and p.depth <= f.depth group by p.key
)
select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, f.ends_sha256 from f join s using (key) left join f u on u.key = f.parent
"""
