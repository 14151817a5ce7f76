"""Repeated stretches of texts, found through sampled suffixes: what substring and suffix-array dedup share.

A stretch of ``window`` units (words or bytes) is repeated if it also starts elsewhere. Instead of all suffixes, those
are kept that start at an anchor: of each ``window - gram + 1`` consecutive ``gram``-unit stretches, the one with the
smallest hash. Each window holds an anchor, and equal windows hold equal anchors at equal places, so two occurrences of
a window always meet in the group of their anchor: they agree on some units left of it and some right of it, ``window``
in all. What has to be known of a sampled suffix is thus its next ``window`` units and the ``window - gram`` before it.

Suffixes may come out of their scan as sorted shards (``Kind.shard``): a shard is the suffixes of a stretch of texts, in
order, with what each shares with the one before it; ``tree`` merges shards and need not sort what they have sorted.

Only anchors that occur twice give rise to a suffix at all, and only the first of equal texts takes part (what is
repeated in its copies follows from it), so what is shuffled follows the repeated part of the corpus:

1. ``facts``: one scan; per row its size, a key of its content, the digest of all it keeps, and its anchors' hashes.
2. ``shared anchors``: counted with a combine before the shuffle.
3. ``suffixes``: texts that have one, read once more and written with their anchors; per anchor the units around it.
4. groups by anchor are shuffled, sorted and streamed through tasks in chunks of whole groups (``judge``). A group
   beyond ``GROUP`` suffixes is not held in a task: its prefixes are lengthened until the parts can be held
   (``long_prefixes``).
5. ``spans`` meet the texts of step 3 again, by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw
from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

#: Suffixes of a group that one task may hold, and of a chunk.
GROUP, CHUNK = 20_000, 10_000
#: Rows of one key in a join of hot anchors that a task gets, but for a fixed share of a hotter key's.
HELD = 2000


#: From groups and units ahead: the order of suffixes, and how many units each shares with the one before (-1 at a group's start).
Shard = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Kind(NamedTuple):
    window: int
    gram: int
    words: bool  #: else bytes
    ordered: bool  #: only what also starts in a smaller id is removed; else all occurrences are
    shard: Shard | None = None  #: sorts the suffixes of a shard

    @property
    def left(self) -> int:
        return self.window - self.gram


class Units(NamedTuple):
    """The units of a slice of texts."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def units(s: tw.Slice, kind: Kind) -> Units:
    if kind.words:
        return Units(*tw.words(s, tw.NON_SPACE, lower=False))
    at = np.arange(len(s.data))
    return Units(at, at + 1, s.offsets, s.data.astype(np.uint64) + np.uint64(1))


def anchors(u: Units, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Units at which anchors start, and their hashes."""
    at, gram = tw.grams(u.hash, tw.row_of(u.first), kind.gram)
    picked = tw.winnow(at, gram, kind.window - kind.gram + 1)
    return at[picked], gram[picked]


def kept_digest(text: bytes, u: Units, lo: int, hi: int, base: int, gone: np.ndarray | None, kind: Kind) -> str:
    """sha256 of the units lo to hi without those marked gone; base: the slice's byte at which text starts."""
    if kind.words:
        stay = range(lo, hi) if gone is None else (np.flatnonzero(~gone) + lo).tolist()
        start, end = u.start[lo:hi] - base, u.end[lo:hi] - base
        return hashlib.sha256(b" ".join(text[a:b] for a, b in zip(start[np.array(stay, int) - lo].tolist(), end[np.array(stay, int) - lo].tolist(), strict=True))).hexdigest()
    return hashlib.sha256(text if gone is None else np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest()


def facts(docs: DataFrame, kind: Kind, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h, text), h telling rows of equal id apart, and per row: id, h, n, key, digest, anchors."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("h"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys, digests, found = [], [], [], []
            for s in tw.slices(b.column(2)):
                u = units(s, kind)
                at, gram = anchors(u, kind)
                cut = np.searchsorted(at, u.first)
                raw = s.data.tobytes()
                for r in range(s.hi - s.lo):
                    lo, hi = int(u.first[r]), int(u.first[r + 1])
                    base = int(s.offsets[r])
                    n.append(hi - lo)
                    digest = kept_digest(raw[base : int(s.offsets[r + 1])], u, lo, hi, base, None, kind)
                    digests.append(digest)
                    keys.append(bytes.fromhex(digest)[:16] if hi - lo >= kind.window else None)
                    found.append(gram[cut[r] : cut[r + 1]].view(np.int64))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(digests, pa.string()), lists], ["id", "h", "n", "key", "digest", "anchors"])

    return rows, rows.mapInArrow(scan, "id bigint, h bigint, n bigint, key binary, digest string, anchors array<bigint>")


#: ``shard`` has a number for each shard of a partition; the other four are a suffix's place in its shard and what it shares with the one before, right and left of the anchor.
SUFFIX = "anchor bigint, id bigint, h bigint, at bigint, nl int, ctx binary, shard bigint, place_r int, same_r int, place_l int, same_l int"
_SUFFIX = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("nl", pa.int32()), ("ctx", pa.binary()), ("shard", pa.int64()), *((c, pa.int32()) for c in ("place_r", "same_r", "place_l", "same_l"))])


def suffixes(flagged: DataFrame, kind: Kind) -> DataFrame:
    """flagged: id, h, text, shared (array of anchors). Per occurrence of one: the bytes from ``nl`` units before it to ``window`` after its start."""

    def sharded(out: list[list], number: int) -> pa.RecordBatch:
        columns = [pa.array(x, _SUFFIX.field(i).type) for i, x in enumerate(out)]
        n = len(columns[0])
        places = [np.zeros(n, np.int32) for _ in range(4)]
        if kind.shard and n:
            group, nl = columns[0].to_numpy(), columns[4].to_numpy().astype(np.int64)
            right, left, _ = windows(columns[5], nl, kind)
            for k, ahead in ((0, right), (2, left)):
                order, same = kind.shard(group, ahead)
                places[k][order] = np.arange(n)
                places[k + 1][order] = same
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, number)), *map(pa.array, places)], schema=_SUFFIX)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for b in batches:
            ids, hs, shared = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)
            for s in tw.slices(b.column(2), tw.SLICE // 4):
                u = units(s, kind)
                at, gram = anchors(u, kind)
                cut = np.searchsorted(at, u.first)
                raw = s.data.tobytes()
                out: list[list] = [[] for _ in range(6)]
                for r in range(s.hi - s.lo):
                    own_at, own = at[cut[r] : cut[r + 1]], gram[cut[r] : cut[r + 1]].view(np.int64)
                    mine = np.isin(own, shared[s.lo + r].values.to_numpy())
                    own_at, own = own_at[mine], own[mine]
                    lo, hi = np.maximum(own_at - kind.left, u.first[r]), np.minimum(own_at + kind.window, u.first[r + 1])
                    out[0] += own.tolist()
                    out[1] += [ids[s.lo + r]] * len(own)
                    out[2] += [hs[s.lo + r]] * len(own)
                    out[3] += (own_at - u.first[r]).tolist()
                    out[4] += (own_at - lo).tolist()
                    out[5] += [raw[x:y] for x, y in zip(u.start[lo].tolist(), u.end[hi - 1].tolist(), strict=True)]
                    if len(out[0]) >= CHUNK:  # what is held of a very long text
                        yield sharded(out, number)
                        out, number = [[] for _ in range(6)], number + 1
                yield sharded(out, number)
                number += 1

    return flagged.select("id", "h", "text", "shared").mapInArrow(scan, SUFFIX)


def windows(ctx: pa.Array, nl: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units right of each anchor's start (n x window) and left of it, from the near end (n x left), zero beyond the text; and the number of units right."""
    n, unit = len(ctx), np.uint64 if kind.words else np.uint16
    right, left = np.zeros((n, kind.window), unit), np.zeros((n, kind.left), unit)
    nr = np.zeros(n, np.int64)
    for s in tw.slices(ctx):
        u = units(s, kind)
        row = tw.row_of(u.first) + s.lo
        place = np.arange(len(row)) - u.first[row - s.lo] - nl[row]
        r = place >= 0
        right[row[r], place[r]] = u.hash[r]
        left[row[~r], -1 - place[~r]] = u.hash[~r]
        nr[s.lo : s.hi] = np.diff(u.first) - nl[s.lo : s.hi]
    return right, left, nr


#: From groups, units ahead, and each suffix's shard, place in it and what it shares there: as ``Shard``, over all shards.
Tree = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def judge(t: pa.Table, kind: Kind, tree: Tree) -> pa.RecordBatch:
    """Per suffix of whole groups that has a repeated window: id, h, and the units of its row from first to end.

    ``tree`` orders the suffixes of each group and gives, with the order, how many units neighbours share. For each
    split of a window into units left and right of the anchor, suffixes below one node of that depth on both sides
    hold the same window.
    """
    t = t.combine_chunks()
    group, ids, nl = t.column("anchor").to_numpy(), t.column("id").to_numpy(), t.column("nl").to_numpy().astype(np.int64)
    right, left, nr = windows(t.column("ctx").chunk(0), nl, kind)
    shard, place_r, same_r, place_l, same_l = (t.column(c).to_numpy() for c in ("shard", "place_r", "same_r", "place_l", "same_l"))
    order_r, depth_r = tree(group, right, shard, place_r, same_r)
    order_l, depth_l = tree(group, left, shard, place_l, same_l)
    n = len(group)
    most_left, most_right = np.full(n, -1), np.full(n, -1)
    for l in range(kind.left + 1):
        fits = np.flatnonzero((nl >= l) & (nr >= kind.window - l))
        if len(fits) < 2:
            continue
        node_r, node_l = np.empty(n, np.int64), np.empty(n, np.int64)
        node_r[order_r] = np.cumsum(depth_r < kind.window - l)
        node_l[order_l] = np.cumsum(depth_l < l)
        key = node_r[fits] * (n + 1) + node_l[fits]
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=-1))
        size = np.diff(begins, append=len(order))
        many = np.repeat(size, size) > 1
        if kind.ordered:
            many &= ids[fits[order]] > np.repeat(np.minimum.reduceat(ids[fits[order]], begins), size)
        hit = fits[order[many]]
        most_left[hit] = l
        most_right[hit] = np.maximum(most_right[hit], kind.window - l)
    hit = np.flatnonzero(most_left >= 0)
    at = t.column("at").to_numpy()[hit]
    return pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(t.column("h").to_numpy()[hit]), pa.array(at - most_left[hit]), pa.array(at + most_right[hit])], ["id", "h", "first", "end"])


SPAN = "id bigint, h bigint, first bigint, end bigint"


def trimmed(ctx: pa.Array, nl: np.ndarray, left: int, right: int, kind: Kind) -> tuple[pa.Array, np.ndarray]:
    """Surroundings cut down to so many units left of the anchor's start and right of it, and how many are left of it then."""
    out: list[bytes] = []
    kept = np.minimum(nl, left)
    for s in tw.slices(ctx):
        u = units(s, kind)
        begin = u.first[:-1] + nl[s.lo : s.hi] - kept[s.lo : s.hi]
        end = np.minimum(u.first[:-1] + nl[s.lo : s.hi] + right, u.first[1:])
        raw = s.data.tobytes()
        if kind.words:  # what parts words makes no difference
            out += [b" ".join(raw[u.start[k] : u.end[k]] for k in range(x, y)) for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
        else:
            out += [raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
    return pa.array(out, pa.binary()), kept


def long_prefixes(hot: DataFrame, kind: Kind, tree: Tree, scratch: Scratch) -> DataFrame:
    """Spans of groups that are too large to hold.

    Suffixes with the same surroundings are one: all windows in these are repeated, and only one of the suffixes goes on. A
    group that is still too large is then split by longer prefixes. Of a window's ``kind.left`` units beyond the anchor,
    either at least half stand left of it or more than the others do right of it, so each suffix goes to the group of those
    that share that many units on its left, and to that of those that do on its right. All that hold a window meet in one
    of the two. Surroundings shrink to what such windows can reach, so more of them are the same, and what is too large is
    split again, with half of the units open that were open before; in the end a group is a single window.
    """
    row, names = F.xxhash64("id", "h", "at"), ["anchor", "id", "h", "at", "nl", "ctx", "a", "r"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nl = b.column(4).to_numpy().astype(np.int64)
            _, _, nr = windows(b.column(5), nl, kind) if len(b) else (0, 0, np.zeros(0, np.int64))
            at = b.column(3).to_numpy()
            whole = nl + nr >= kind.window
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(at - nl), pa.array(at + nr)], ["id", "h", "first", "end"]).filter(pa.array(whole))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            nl, a, r = (b.column(i).to_numpy().astype(np.int64) for i in (4, 6, 7))
            right, left, nr = windows(b.column(5), nl, kind)
            for cell in np.unique(a << 32 | r).tolist():
                mine, a0, r0 = np.flatnonzero(a << 32 | r == cell), cell >> 32, cell & 0xFFFFFFFF
                half = (kind.left - a0 - r0 + 1) // 2
                for side, a1, r1 in ((0, a0 + half, r0), (1, a0, kind.left - a0 - half + 1)):
                    fits = mine[(nl[mine] >= a1) & (nr[mine] >= kind.gram + r1)]
                    beyond = (left[fits, :a1] if side == 0 else right[fits, kind.gram : kind.gram + r1]).astype(np.uint64)
                    lo = np.arange(len(fits)) * beyond.shape[1]
                    key = tw.mix(b.column(0).to_numpy().view(np.uint64)[fits] + tw.rolling(beyond.ravel() + np.uint64(1), lo, lo + beyond.shape[1]) * np.uint64(2 + side))
                    own = pa.array(fits)
                    ctx, kept = trimmed(b.column(5).take(own), nl[fits], kind.left - r1, kind.window - a1, kind)
                    yield pa.RecordBatch.from_arrays([tw.as_long(key), *(b.column(i).take(own) for i in range(1, 4)), pa.array(kept, pa.int32()), ctx, pa.array(np.full(len(fits), a1), pa.int32()), pa.array(np.full(len(fits), r1), pa.int32())], names)

    found, todo = [], hot.select("anchor", "id", "h", "at", "nl", "ctx", F.lit(0).alias("a"), F.lit(0).alias("r"))
    while True:
        around = F.unhex(F.md5(F.concat(F.col("nl").cast("string").cast("binary"), F.lit(b":"), "ctx")))
        todo = scratch.write(todo.withColumn("around", around))
        owner = scratch.write(todo.groupBy("anchor", "around").agg(F.min("id").alias("o"), F.count("*").alias("m"), F.min(row).alias("one")))
        copies = hot_join(todo, owner.where("m > 1").select("anchor", "around", "o", "m"), ["anchor", "around"], "m", HELD)
        copies = copies.where("id > o") if kind.ordered else copies
        found.append(copies.select("anchor", "id", "h", "at", "nl", "ctx").mapInArrow(measure, SPAN))
        # joined by the row that goes on, so that no surroundings gather their rows
        key = ["anchor", "around", "id"] if kind.ordered else ["anchor", "around", "one"]
        stand = todo.withColumn("one", row).join(owner.select("anchor", "around", "one", F.col("o").alias("id")).select(*key), key).select(*names)
        stand = scratch.write(stand)
        sizes = stand.groupBy("anchor").agg(F.count("*").alias("m"), F.min("id").alias("o"), F.max("id").alias("last"))
        sizes = scratch.write(sizes.where("o < last" if kind.ordered else "m > 1").select("anchor", "m"))
        known = hot_join(stand, sizes, ["anchor"], "m", HELD)
        small = known.where(F.col("m") <= GROUP).select("anchor", "id", "h", "at", "nl", "ctx", F.monotonically_increasing_id().alias("shard"), *(F.lit(0).alias(c) for c in ("place_r", "same_r", "place_l", "same_l")))
        found.append(_judged(small, kind, tree))
        todo = known.where((F.col("m") > GROUP) & (F.col("a") + F.col("r") < kind.left)).select(*names)  # a single window has one owner
        if todo.isEmpty():
            break
        todo = todo.mapInArrow(split, "anchor bigint, id bigint, h bigint, at bigint, nl int, ctx binary, a int, r int")
    return reduce(DataFrame.union, found)


def _judged(found: DataFrame, kind: Kind, tree: Tree) -> DataFrame:
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tw.whole_groups(batches, CHUNK):
            yield judge(t, kind, tree)

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(stream, SPAN)


def find(docs: DataFrame, kind: Kind, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n``, ``n_removed``, ``n_spans``, ``digest`` (of what is kept) and ``spans`` (first and end unit of each maximal removed run; null where all of a copy goes)."""
    scratch = Scratch(docs.sparkSession, "repeats")
    rows, all_facts = facts(docs, kind, id_col, text_col)
    all_facts = scratch.write(all_facts)
    long = all_facts.where("key IS NOT NULL" + (" AND id IS NOT NULL" if kind.ordered else ""))
    first = long.groupBy("key").agg(F.min(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("i"), "h")).alias("o"), F.min("id").alias("least"), F.count("*").alias("m"))
    first = scratch.write(first.select("key", "o.i", F.col("o.h").alias("oh"), "least", "m"))
    # one row of each content takes part, under its own id
    # joined by the row, so that no content gathers its copies
    takes = long.withColumn("i", F.coalesce("id", F.lit(-(1 << 63)))).join(first.select("key", "i", F.col("oh").alias("h")), ["key", "i", "h"]).dropDuplicates(["key"])
    held = scratch.write(takes.select(F.col("i").alias("id"), "h", F.explode("anchors").alias("anchor")))
    counted = held.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("m"))
    # written, so that the join's two sides are dealt out apart from the count and Spark can split the rows of a hot anchor
    shared = scratch.write(counted.where("lo < hi" if kind.ordered else "m > 1").select("anchor", "m"))
    mine = hot_join(held, shared, ["anchor"], "m", GROUP).groupBy("id", "h").agg(F.collect_set("anchor").alias("shared"), F.collect_set(F.when(F.col("m") > GROUP, F.col("anchor"))).alias("hot"))
    keyed = rows.select(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "h", "text")
    flagged = scratch.write(keyed.join(mine, ["id", "h"]).dropDuplicates(["id", "h"]))

    found = suffixes(flagged.withColumn("shared", F.array_except("shared", "hot")), kind)

    spans = _judged(found, kind, tree)
    hot = flagged.where(F.size("hot") > 0).withColumn("shared", F.col("hot"))
    if not hot.isEmpty():
        spans = spans.union(long_prefixes(suffixes(hot, kind._replace(shard=None)), kind, tree, scratch))
    spans = spans.groupBy("id", "h").agg(F.collect_set(F.struct("first", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans, removed, digests, runs = b.column(3), [], [], []
            for s in tw.slices(b.column(2)):
                u = units(s, kind)
                raw = s.data.tobytes()
                for r in range(s.hi - s.lo):
                    lo, hi, base = int(u.first[r]), int(u.first[r + 1]), int(s.offsets[r])
                    own = spans[s.lo + r].values
                    delta = np.zeros(hi - lo + 1, np.int64)
                    np.add.at(delta, own.field("first").to_numpy(), 1)
                    np.add.at(delta, own.field("end").to_numpy(), -1)
                    gone = np.cumsum(delta[:-1]) > 0
                    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                    runs.append([{"first": x, "end": y} for x, y in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True)])
                    removed.append(int(gone.sum()))
                    digests.append(kept_digest(raw[base : int(s.offsets[r + 1])], u, lo, hi, base, gone, kind))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(runs, run)], ["id", "h", "removed", "left", "runs"])

    done = flagged.select("id", "h", "text").join(spans, ["id", "h"]).mapInArrow(cut, "id bigint, h bigint, removed bigint, left string, runs array<struct<first:bigint,end:bigint>>")
    nothing = hashlib.sha256(b"").hexdigest()
    # a row that is a copy goes whole; else it has the spans of the row with its content that took part
    fate = first.join(done.withColumnRenamed("id", "i").withColumnRenamed("h", "oh"), ["i", "oh"], "left").select("key", "least", "m", "removed", "left", "runs")
    copy = (F.col("id") > F.col("least")) if kind.ordered else (F.col("m") > 1)
    columns = ["id", "n", "digest"]
    judged = hot_join(long.select("key", *columns), scratch.write(fate), ["key"], "m", HELD).select(*columns, copy.alias("copy"), "removed", "left", "runs")
    # what is shorter than a window (or, where ids are compared, has none) meets nothing
    rest = all_facts.where("key IS NULL" + (" OR id IS NULL" if kind.ordered else "")).select(*columns)
    out = judged.unionByName(rest, allowMissingColumns=True)
    copy = F.coalesce("copy", F.lit(False))
    return out.select(
        F.col("id").alias(id_col),
        "n",
        F.when(copy, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce(F.size("runs"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("left", "digest")).alias("digest"),
        F.when(~copy, F.coalesce("runs", F.array().cast("array<struct<first:bigint,end:bigint>>"))).alias("spans"),
    )
