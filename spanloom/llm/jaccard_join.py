"""Documents whose sets of word n-grams are as similar as asked, exactly, by adaptive multi-match prefixes.

Two sets with at least ``t`` tokens in common, each sorted by one global order, share at least ``l`` of their first
``size - t + l`` tokens, for any ``l`` up to ``t``. A longer prefix (a larger ``l``) asks for more shared tokens before a
pair is verified. Of two documents with different ``l``, the smaller one counts: both prefixes hold what it speaks of.

1. ``sketches``: one scan; each set's size, key and prefix in the order of hashes, lengthened by a ``SHARE``-th of the set.
2. ``alive``: prefix tokens that different sets share are counted. A document with fewer of these than any partner of its
   would need has no partner. Of equal sets one row takes part.
3. ``ranked``: what is alive is read once more. Its tokens are counted, and those that two sets have are sorted by
   frequency, rare ones first; tokens of one set alone come before these and match nothing, so they are left out. From here
   on intersections are those of what is left, and are still exact.
4. ``adapted``: each document chooses its ``l``: a prefix token costs ``ENTRY``, matches in the prefix (the sum of its
   tokens' frequencies) cost one each, and at most a ``l``-th of these many documents has to be verified at the cost of the
   set.
5. Documents that share a token of their shortest prefixes (``l`` = 1) are tied, and connected components of ties are
   clusters. A cluster of at most ``CLUSTER`` tokens and ``MEMBERS`` documents is worked by one task: a breadth-first search
   over an inverted list of the lengthened prefixes, in which a document that is reached is not compared again, so a
   group of copies takes few comparisons. Beyond ``WORK`` steps the cluster is handed on, with nothing lost.
6. In those and in larger clusters, most ties are by chance, and the more documents there are, the more of them chance ties to
   one another. There, two documents of a token are tied (``tied``) only if the bits of their sets allow it: each token
   flips one bit, so bits that differ are at most as many as tokens that only one of the two has. Bits are as many as
   tokens, and no link is lost. What is tied then makes new clusters, which are worked as in 5.
7. What is still too large or too much work is worked in rounds (``rounds``): each token's documents name leaders, which are compared with
   the token's other documents in other components; then they lead no more. Rounds end when no token has two documents in
   different components that have not led. No pairs within a component are made, and the documents of a frequent token
   are dealt over tasks.

Defined results: null texts and texts without words have an empty set and are linked with nothing; a document of fewer words
than a shingle is a set of one; rows with a null id stay alone with a null component; repeated rows are one document, and so
are rows of one id with different texts, which is linked as any of them; an empty table gives an empty table; other columns
are ignored. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm import near_dedup
from spanloom.llm import textwork as tw
from spanloom.llm.components import components
from spanloom.llm.skew import FEW, hot_join
from spanloom.session import Scratch

WORDS, PERCENT = 4, 85
SHARE = 20  #: prefixes in the order of hashes are longer by one token for so many tokens of the set
CLUSTER, MEMBERS = 4_000_000, 20_000  #: tokens and documents of a cluster that a task holds
WORK = 300_000_000  #: prefix matches and verified tokens that a task spends on a cluster
ENTRY = 4  #: what a prefix token costs by itself, in matches
BLOCK = 10_000  #: documents of a token whose bits a task compares with those of as many others
HELD = 2000  #: rows of one key in a join that a task gets, but for a fixed share of a hotter key's


def overlap(n, percent: int):
    """Tokens that a set of n has to share with any partner."""
    return -(-percent * n // 100)


def matches(n, percent: int):
    """Tokens that a prefix in the order of hashes asks for."""
    return np.minimum(overlap(n, percent), 1 + n // SHARE)


def sketches(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n, key and k (128 and 64 bits of the set), least (shared prefix tokens that a partner takes), prefix."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys, prefix = [], [], []
            for x in near_dedup.shingle_sets(b.column(1), words):
                n.append(len(x))
                keys.append(near_dedup.set_key(x) if len(x) else None)
                prefix.append(x[: len(x) - overlap(len(x), percent) + int(matches(len(x), percent))].view(np.int64))
            size = np.array(n, np.int64)
            k = pa.array([int.from_bytes(x[:8], "little", signed=True) if x else None for x in keys], pa.int64())
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, prefix)]).astype(np.int32), pa.array(np.concatenate([np.zeros(0, np.int64), *prefix])))
            least = matches(overlap(size, percent), percent)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(keys, pa.binary()), k, pa.array(least.astype(np.int32)), lists], ["id", "n", "key", "k", "least", "prefix"])

    return rows.mapInArrow(tw.tidy(scan), "id bigint, n bigint, key binary, k bigint, least int, prefix array<bigint>")


def alive(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows: id, k, least, prefix. id, k of those that share enough prefix tokens with other sets."""
    tokens = rows.select("id", "k", "least", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    shared = scratch.write(shared.select("token", "m"))
    return hot_join(tokens, shared, ["token"], "m", HELD).groupBy("id", "k", "least").agg(F.count("*").alias("c")).where("c >= least").select("id", "k")


def ranked(texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """texts: id, key, k, text. Per set: id, k, n, m and token (arrays, rare tokens first, without those of this set alone)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(1)
            for s in range(0, len(b), 100):
                part = b.slice(s, 100)
                sets = list(near_dedup.shingle_sets(part.column(3), words))
                own = [i for i, x in enumerate(sets) if len(x) and near_dedup.set_key(x) == keys[s + i].as_py()]
                lists = pa.ListArray.from_arrays(np.cumsum([0, *(len(sets[i]) for i in own)]).astype(np.int32), pa.array(np.concatenate([np.zeros(0, np.int64), *(sets[i].view(np.int64) for i in own)])))
                at = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), pa.array([len(sets[i]) for i in own], pa.int64()), lists], ["id", "k", "n", "tokens"])

    sets = scratch.write(texts.select("id", "key", "k", "text").mapInArrow(tw.tidy(scan), "id bigint, k bigint, n bigint, tokens array<bigint>"))
    tokens = sets.select("id", "k", "n", F.explode("tokens").alias("token"))
    often = scratch.write(tokens.groupBy("token").agg(F.count("*").alias("m")).where("m > 1"))
    own = hot_join(tokens, often, ["token"], "m", HELD).groupBy("id", "k", "n").agg(F.array_sort(F.collect_list(F.struct("m", "token"))).alias("s"))
    return own.select("id", "k", "n", F.col("s.m").alias("m"), F.col("s.token").alias("tokens"))


def adapt(m: np.ndarray, n: int, percent: int) -> tuple[int, int]:
    """m: how many sets have each token, rare ones first. The number of shared tokens to ask for, and the prefix's length."""
    t = int(overlap(n, percent))
    shortest = len(m) - t + 1
    found = np.cumsum(m - 1)[shortest - 1 :]  # matches in the prefix, by what is asked for
    ask = np.arange(1, len(found) + 1)
    best = int((ENTRY * (shortest + ask) + found * (1 + len(m) / ask)).argmin())
    return best + 1, shortest + best


def adapted(sets: DataFrame, percent: int) -> DataFrame:
    """sets as ``ranked`` gives them. Those that can have partners: id, k, n, ask, long and short (lengths of prefixes), tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy()
            size = b.column(3).value_lengths().to_numpy()
            own = np.flatnonzero(size >= overlap(n, percent))
            chosen = np.array([adapt(b.column(3)[i].values.to_numpy(), int(n[i]), percent) for i in own.tolist()], np.int32).reshape(-1, 2)
            short = (size[own] - overlap(n[own], percent) + 1).astype(np.int32)
            at = pa.array(own)
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(3)), pa.array(chosen[:, 0]), pa.array(chosen[:, 1]), pa.array(short), b.column(4).take(at)], ["id", "k", "n", "ask", "long", "short", "tokens"])

    return sets.select("id", "k", "n", "m", "tokens").mapInArrow(tw.tidy(scan), "id bigint, k bigint, n bigint, ask int, long int, short int, tokens array<bigint>")


class Lists:
    """Inverted lists of prefixes: by token, the documents (of those given) whose prefix has it."""

    def __init__(self, docs: np.ndarray, prefixes: list[np.ndarray], size: int):
        code = np.concatenate([prefixes[d] for d in docs.tolist()])
        doc = np.repeat(docs, [len(prefixes[d]) for d in docs.tolist()])
        order = np.argsort(code, kind="stable")
        self.doc, self.first = doc[order], np.searchsorted(code[order], np.arange(size + 1))

    def of(self, codes: np.ndarray) -> np.ndarray:
        lo, n = self.first[codes], self.first[codes + 1] - self.first[codes]
        return self.doc[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]


def reach(ids: np.ndarray, n: np.ndarray, ask: np.ndarray, long: np.ndarray, tokens: list[np.ndarray], percent: int) -> np.ndarray | None:
    """By document: the smallest id of its component, or nothing after too much work."""
    distinct, codes = np.unique(np.concatenate(tokens), return_inverse=True)
    codes = np.split(codes, np.cumsum([len(x) for x in tokens])[:-1])
    prefixes = [c[:x] for c, x in zip(codes, long.tolist(), strict=True)]
    mark = np.zeros(len(distinct), bool)
    size = np.array([len(c) for c in codes])
    comp, free = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
    order = np.argsort(ids, kind="stable")
    lists, listed, left, work = Lists(order, prefixes, len(distinct)), len(ids), len(ids), 0
    for seed in order.tolist():
        if not free[seed]:
            continue
        free[seed], comp[seed], todo = False, ids[seed], [seed]
        left -= 1
        while todo and left:
            x = todo.pop()
            if 2 * left < listed:  # lists of what is left only
                lists, listed = Lists(np.flatnonzero(free), prefixes, len(distinct)), left
            met = lists.of(prefixes[x])
            work += len(met) + len(prefixes[x])
            others, shared = np.unique(met[free[met]], return_counts=True)
            fits = (shared >= np.minimum(ask[others], ask[x])) & (100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x]))
            others = others[fits]
            work += int(size[others].sum())
            if work > WORK:
                return None
            if not len(others):
                continue
            mark[codes[x]] = True
            both = np.add.reduceat(mark[np.concatenate([codes[y] for y in others.tolist()])].astype(np.int64), np.cumsum(size[others]) - size[others])
            mark[codes[x]] = False
            linked = others[100 * both >= percent * (n[x] + n[others] - both)]
            comp[linked], free[linked] = comp[seed], False
            left -= len(linked)
            todo += linked.tolist()
    return comp


def resolve(sets: DataFrame, percent: int) -> DataFrame:
    """sets: cluster and what ``adapted`` gives, dealt and sorted by cluster. Per set: node, comp; comp is null in clusters that were given up."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        cluster, ids, n, ask, long = (t.column(c).to_numpy() for c in ("cluster", "id", "n", "ask", "long"))
        lists = t.column("tokens").chunk(0)
        tokens = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        begins = np.flatnonzero(np.diff(cluster, prepend=cluster[0] - 1))
        comp: list[pa.Array] = []
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(ids)], strict=True):
            found = reach(ids[a:b], n[a:b], ask[a:b], long[a:b], tokens[a:b], percent)
            comp.append(pa.nulls(b - a, pa.int64()) if found is None else pa.array(found))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.concat_arrays(comp)], ["node", "comp"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tw.whole_groups(batches, 500):
            yield solve(t)

    return sets.select("cluster", "id", "n", "ask", "long", "tokens").mapInArrow(tw.tidy(stream), "node bigint, comp bigint")


def bits(tokens: np.ndarray) -> bytes:
    """A bit for each token, flipped by it, at least as many as there are tokens (a power of two)."""
    width = 1 << max(6, int(len(tokens) - 1).bit_length())
    at = np.bincount((tokens.view(np.uint64) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(at.astype(np.uint8), bitorder="little").tobytes()


def fold(rows: np.ndarray, words: int) -> np.ndarray:
    """rows of 64-bit words, each as it would be with fewer bits."""
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _few(n: list[int], size: list[int], sets: list[bytes], percent: int) -> tuple[list[int], list[int]]:
    """What ``forest`` does, for few documents: numbers of any length take less time than arrays."""
    ints, width = [int.from_bytes(x, "little") for x in sets], [8 * len(x) for x in sets]
    free = list(range(len(n)))
    a, b = [], []
    while free:
        todo = [free.pop()]
        while todo:
            x = todo.pop()
            rest = []
            for y in free:
                shared = -(-percent * (n[x] + n[y]) // (100 + percent))
                p, q, w, v = ints[x], ints[y], width[x], width[y]
                while w > v:
                    w //= 2
                    p = (p >> w) ^ (p & ((1 << w) - 1))
                while v > w:
                    v //= 2
                    q = (q >> v) ^ (q & ((1 << v) - 1))
                if shared <= min(size[x], size[y]) and (p ^ q).bit_count() <= size[x] + size[y] - 2 * shared:
                    a.append(x)
                    b.append(y)
                    todo.append(y)
                else:
                    rest.append(y)
            free = rest
    return a, b


def forest(n: np.ndarray, size: np.ndarray, sets: list[bytes], percent: int) -> tuple[list[int], list[int]]:
    """Pairs (by place) whose bits allow a link, as far as they are needed to connect what such pairs connect. size: tokens that make the bits."""
    if len(n) <= 16:
        return _few(n.tolist(), size.tolist(), sets, percent)
    width = np.array([len(x) // 8 for x in sets])
    groups = {int(w): np.flatnonzero(width == w) for w in np.unique(width)}  # rows of one width are compared at once
    rows = {w: np.frombuffer(b"".join(sets[i] for i in at.tolist()), "<u8").reshape(-1, w) for w, at in groups.items()}
    free = np.ones(len(n), bool)
    a, b = [], []
    for seed in range(len(n)):
        if not free[seed]:
            continue
        free[seed], todo = False, [seed]
        while todo:
            x = todo.pop()
            own = np.frombuffer(sets[x], "<u8").reshape(1, -1)
            for w, at in groups.items():
                keep = free[at]
                if 2 * np.count_nonzero(keep) < len(at):
                    groups[w], rows[w], at = at[keep], rows[w][keep], at[keep]
                    keep = np.ones(len(at), bool)
                shared = -(-percent * (n[x] + n[at]) // (100 + percent))  # what a link takes
                spare = size[x] + size[at] - 2 * shared
                found = np.flatnonzero(keep & (spare >= 0) & (shared <= np.minimum(size[x], size[at])))
                if not len(found):
                    continue
                least = min(w, own.shape[1])
                apart = np.bitwise_count(fold(rows[w][found], least) ^ fold(own, least)).sum(axis=1, dtype=np.int64)
                met = at[found[apart <= spare[found]]].tolist()
                free[met] = False
                a += [x] * len(met)
                b += met
                todo += met
    return a, b


def tied(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """members: token, id, k. sets: as ``adapted`` gives them, written. Pairs (a, b: ids) that share a token of ``members`` and whose bits allow a link, or as few of them as connect the same."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            lists = x.column(3)
            made = pa.array([bits(lists[i].values.to_numpy()) for i in range(len(lists))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(x.column(i) for i in range(3)), lists.value_lengths(), made], ["id", "k", "n", "size", "bits"])

    def solve(t: pa.Table) -> pa.RecordBatch:
        keys = np.stack([t.column(c).to_numpy() for c in ("token", "i", "j")])
        begins = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        ids, n, size = (t.column(c).to_numpy() for c in ("id", "n", "size"))
        sets = t.column("bits").to_pylist()
        a, b = [], []
        for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(ids)], strict=True):
            x, y = forest(n[lo:hi], size[lo:hi], sets[lo:hi], percent)
            a += [lo + v for v in x]
            b += [lo + v for v in y]
        return pa.RecordBatch.from_arrays([pa.array(ids[np.array(a, np.int64)]), pa.array(ids[np.array(b, np.int64)])], ["a", "b"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tw.whole_groups(batches, 5000):
            yield solve(t)

    # near copies share many tokens: of tokens that the same documents have, one is enough
    whose = members.groupBy("token").agg(F.count("*").alias("m"), F.sum(F.xxhash64("id", "k").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("k", "id")).alias("x"))
    tokens = scratch.write(whose.where("m > 1").groupBy("m", "s", "x").agg(F.min("token").alias("token")).select("token", "m"))
    members = scratch.write(hot_join(members, tokens, ["token"], "m", HELD))
    signed = scratch.write(sets.select("id", "k", "n", "tokens").mapInArrow(tw.tidy(sign), "id bigint, k bigint, n bigint, size int, bits binary"))
    # the documents of a frequent token are dealt to parts, and any two parts meet in a group of their own
    dealt = members.join(signed, ["id", "k"])
    group = [F.xxhash64("token", "i", "j").alias("group"), "token", "i", "j", "id", "n", "size", "bits"]
    once = dealt.where(F.col("m") <= BLOCK).withColumns({"i": F.lit(0), "j": F.lit(0)}).select(*group)
    parts = F.ceil(F.col("m") / (BLOCK // 2)).cast("int")
    often = dealt.where(F.col("m") > BLOCK).withColumn("p", F.pmod(F.xxhash64("id", "k"), parts).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), parts - 1))).where("o <> p")
    often = often.withColumns({"i": F.least("p", "o"), "j": F.greatest("p", "o")}).select(*group)
    rows = once.unionByName(often) if not tokens.where(F.col("m") > BLOCK).isEmpty() else once
    return rows.repartition("group").sortWithinPartitions("group", "token", "i", "j").mapInArrow(tw.tidy(stream), "a bigint, b bigint").where("a <> b").distinct()


def rounds(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """members: token, id, k. sets: as ``adapted`` gives them, written. node, comp of those that have a link."""
    spark = members.sparkSession
    links, comp = spark.createDataFrame([], "a bigint, b bigint"), spark.createDataFrame([], "node bigint, comp bigint")
    round_ = 0
    while True:
        named = scratch.write(members.join(comp.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "k", F.coalesce("comp", "id").alias("comp")))
        open_ = scratch.write(named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("token", "m"))
        rest = scratch.write(hot_join(named, open_, ["token"], "m", HELD))
        if rest.isEmpty():
            return comp
        # twice as many leaders in each round, so that documents of one token that are not linked take few rounds
        salt = F.pmod(F.xxhash64("id", "k"), F.lit(1 << round_)).alias("salt")
        leads = rest.groupBy("token", salt).agg(F.min(F.struct("id", "k", "comp")).alias("l"), F.count("*").alias("m"))
        leads = scratch.write(leads.groupBy("token").agg(F.collect_list("l").alias("l"), F.sum("m").alias("m")))
        met = hot_join(rest.drop("m"), leads, ["token"], "m", HELD).select("id", "k", "comp", F.explode("l").alias("l")).where("l.comp <> comp")
        pairs = scratch.write(met.select(F.struct("l.id", "l.k").alias("a"), F.struct("id", "k").alias("b")).distinct())
        found = scratch.write(_verified(pairs, sets, percent, scratch))
        if not found.isEmpty():
            links = scratch.write(links.union(found))
            comp = scratch.write(components(links, scratch))
        members = rest.join(leads.select("token", F.explode("l").alias("l")).select("token", "l.id", "l.k"), ["token", "id", "k"], "left_anti").select("token", "id", "k")
        round_ += 1


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """pairs: a, b (structs of id, k). The linked ones, as a, b (ids): by prefixes first, then by whole sets."""

    def met(pairs: DataFrame, side: str, columns: dict[str, Column]) -> DataFrame:
        counts = pairs.groupBy(side).agg(F.count("*").alias("m"))
        facts = counts.join(sets.select(F.struct("id", "k").alias(side), *(c.alias(f"{name}_{side}") for name, c in columns.items())), side)
        # a leader is in many pairs: its set is sent with each salt, never to all tasks
        return hot_join(pairs, scratch.write(facts), [side], "m", HELD, few=0).drop("m")

    head = {"n": F.col("n"), "ask": F.col("ask"), "prefix": F.slice("tokens", F.lit(1), F.col("long"))}
    near = scratch.write(met(scratch.write(met(pairs, "a", head)), "b", head))
    near = near.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").where(F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.least("ask_a", "ask_b"))
    near = scratch.write(near.select("a", "b", "n_a", "n_b"))
    whole = met(scratch.write(met(near, "a", {"tokens": F.col("tokens")})), "b", {"tokens": F.col("tokens")})
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return whole.where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).where("a <> b").distinct()


def clustered(sets: DataFrame, clusters: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """sets: as ``adapted`` gives them, written. clusters: node, comp. What tasks resolve (node, comp), and the others' ids."""
    clusters = scratch.write(clusters.select(F.col("node").alias("id"), F.col("comp").alias("cluster")))
    held = scratch.write(sets.join(clusters, "id"))
    large = scratch.write(held.groupBy("cluster").agg(F.sum(F.size("tokens")).alias("held"), F.count("*").alias("docs")).where((F.col("held") > CLUSTER) | (F.col("docs") > MEMBERS)))
    small = held.join(F.broadcast(large) if large.limit(FEW + 1).count() <= FEW else large, "cluster", "left_anti")
    found = scratch.write(resolve(small.repartition("cluster").sortWithinPartitions("cluster"), percent))
    hard = scratch.write(found.where("comp IS NULL").select(F.col("node").alias("id")).union(clusters.join(large.select("cluster"), "cluster", "left_semi").select("id")).distinct())
    return found.where("comp IS NOT NULL"), hard


def classes(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id``."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    all_rows = scratch.write(sketches(docs, percent, words, id_col, text_col))
    rows = all_rows.where("key IS NOT NULL AND id IS NOT NULL")
    first = scratch.write(rows.groupBy("key").agg(F.min("id").alias("id"), F.first("k").alias("k"), F.count("*").alias("m")))
    live = first.join(alive(rows, scratch), ["id", "k"]).select("id", "key", "k")
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).where("id IS NOT NULL")
    texts = texts.join(scratch.write(live), "id").dropDuplicates(["id", "key", "text"])
    sets = scratch.write(adapted(ranked(texts, words, scratch), percent))
    prefix = scratch.write(sets.select("id", "k", F.explode(F.slice("tokens", F.lit(1), F.col("short"))).alias("token")))
    shared = scratch.write(prefix.groupBy("token").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("token", "lo", "m"))
    members = scratch.write(hot_join(prefix, shared, ["token"], "m", HELD).select("token", "id", "k", "lo"))
    clusters = components(members.select(F.col("id").alias("a"), F.col("lo").alias("b")), scratch)
    members = members.select("token", "id", "k")
    found, hard = clustered(sets, clusters, percent, scratch)
    if not hard.isEmpty():
        own, their = scratch.write(sets.join(hard, "id", "left_semi")), scratch.write(members.join(hard, "id", "left_semi"))
        more, hard = clustered(own, components(tied(their, own, percent, scratch), scratch), percent, scratch)
        found = found.union(more)
        if not hard.isEmpty():
            found = found.union(rounds(their.join(hard, "id", "left_semi"), scratch.write(own.join(hard, "id", "left_semi")), percent, scratch))
    found = scratch.write(found)
    # an id with several texts takes part as several sets, which are tied here
    several = rows.groupBy("id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("id")
    several = scratch.write(several)
    if not several.isEmpty():
        ties = rows.join(several, "id", "left_semi").select("id", "key").distinct().join(first.select("key", F.col("id").alias("b")), "key").select(F.col("id").alias("a"), "b")
        found = scratch.write(components(found.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(ties), scratch))
    label = first.join(found.groupBy("node").agg(F.min("comp").alias("comp")).withColumnRenamed("node", "id"), "id", "left").select("key", F.coalesce("comp", "id").alias("comp"), "m")
    alone = all_rows.where("key IS NULL OR id IS NULL").select("id", "n", F.col("id").alias("comp"))
    out = hot_join(rows.select("id", "n", "key"), scratch.write(label), ["key"], "m", HELD).select("id", "n", "comp").union(alone)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"))


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs)
