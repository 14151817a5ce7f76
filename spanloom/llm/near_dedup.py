"""Near-duplicate documents by MinHash, banding and connected components.

1. Each document's set of 5-word shingles (64-bit hashes) gives 220 minima of universal hashes and a 128-bit key of the
   set. Documents with equal sets are one class from here on, named by its smallest id.
2. The minima are cut into 44 bands of five. Classes that agree in a band share a bucket. At a similarity of 0.75 two
   sets miss all 44 buckets with a probability of 7e-6; at 0.8 of 3e-8.
3. Each member of a bucket is tied to the bucket's smallest id, and the connected components of these ties (by
   alternating large-star and small-star) are clusters: whatever shares a bucket is in one cluster.
4. Clusters of at most ``CLUSTER`` shingles and ``MEMBERS`` documents are worked by one task each, many to a task: from
   its smallest id on, a breadth-first search compares the documents of a component with those not reached yet. A pair
   passes if its signatures could belong to sets as similar as asked (a test that a true pair fails with a probability
   below 1e-6) and then if its full shingle sets, from the whole texts, really are. What is reached is compared no
   further, so a large group of copies takes few comparisons. A cluster that isn't resolved after ``WORK`` comparisons
   of signatures (texts that resemble but aren't linked) is given up there and handed on, with nothing lost.
5. Those and larger clusters are worked in rounds without ever gathering a bucket: each bucket names leaders, and each
   leader is compared, in the same two steps, with the bucket's other members in other components. Links merge components
   by large-star and small-star. A bucket is done when no two of its members that have not led lie in different
   components; then every pair of its members was compared or is connected already. After ``EASY`` rounds the buckets
   of what is left are replaced by those of an exact prefix filter: two sets as similar as asked share one of the
   rarest shingles that make up a quarter of either, so texts that have only a common frame never meet.

State between steps is written to the shared folder.

Defined results: null texts and texts without words have an empty set and are linked with nothing; a document of one to
four words is a set of one; rows with a null id stay alone with a null component and are kept; repeated rows share a
class and all have its component, so all are kept if the class's id is theirs; an empty table gives an empty table;
other columns are ignored (``classes``) or passed on (``keep_first``). Texts are taken whole, however long; a text's set
of shingles is held by the task that makes or compares it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw
from spanloom.llm.components import components
from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

WORDS = 5
BANDS, ROWS = 44, 5
CLUSTER, MEMBERS = 4_000_000, 20_000  #: shingles (of 8 bytes) and documents (signatures of 880) of a cluster that a task holds
HELD = 2000  #: rows of one key in a join that a task gets, but for a fixed share of a hotter key's
WORK = 40_000_000  #: comparisons of signatures that a task spends on a cluster
EASY = 2  #: rounds with the buckets of bands, before the prefix filter
#: Fixed odd multipliers and offsets of the universal hashes.
_rng = np.random.default_rng(20240229)
MULTIPLY = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for s in tw.slices(column):
        w = tw.words(s, tw.NON_SPACE, lower=True)
        rows = tw.row_of(w.first)
        at, gram = tw.grams(w.hash, rows, size)
        first = np.searchsorted(at, w.first)
        for r in range(s.hi - s.lo):
            n = w.first[r + 1] - w.first[r]
            if 0 < n < size:
                yield tw.rolling(w.hash, w.first[r : r + 1], w.first[r + 1 : r + 2])
            else:
                yield np.unique(gram[first[r] : first[r + 1]])


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima, 32 bits each."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 128):
        np.minimum(low, (shingles[lo : lo + 128, None] * MULTIPLY + ADD).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return np.array([tw.mix(shingles ^ np.uint64(x)).sum(dtype=np.uint64) for x in (0x243F6A8885A308D3, 0x13198A2E03707344)]).tobytes()


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n (set size), key and sig (both null for an empty set)."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys, sigs = [], [], []
            for x in shingle_sets(b.column(1)):
                n.append(len(x))
                keys.append(set_key(x) if len(x) else None)
                sigs.append(signature(x).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["id", "n", "key", "sig"])

    return rows.mapInArrow(tw.tidy(scan), "id bigint, n bigint, key binary, sig binary")


def bands(classes: DataFrame) -> DataFrame:
    """classes: id, sig. Per class and band: bucket, id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.array([np.frombuffer(x.as_py(), np.uint32) for x in b.column(1)]).reshape(len(b), BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(b), BANDS))
            for i in range(ROWS):
                key = tw.mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, i])
            yield pa.RecordBatch.from_arrays([tw.as_long(key.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["bucket", "id"])

    return classes.mapInArrow(tw.tidy(scan), "bucket bigint, id bigint")


def _alike(pairs: DataFrame, need: int) -> DataFrame:
    """pairs: a, b, sa, sb. Those whose signatures agree in ``need`` places at least."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [int((np.frombuffer(x.as_py(), np.uint32) == np.frombuffer(y.as_py(), np.uint32)).sum()) >= need for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(tw.tidy(scan), "a bigint, b bigint")


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    """pairs: a, b, ta, tb (texts). Those whose full sets are as similar as asked."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(shingle_sets(b.column(2)), shingle_sets(b.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(tw.tidy(scan), "a bigint, b bigint")


def least_matches(percent: int) -> int:
    """Places in which the signatures of sets as similar as asked agree, but for a probability below 1e-6."""
    n, p = BANDS * ROWS, percent / 100
    return int(n * p - 5.2 * (n * p * (1 - p)) ** 0.5)


def reach(ids: np.ndarray, sets: list[np.ndarray], sigs: np.ndarray, percent: int) -> np.ndarray | None:
    """By document: the smallest id of its component, or nothing after too much work. Compares by signatures, then by full sets."""
    need, n = least_matches(percent), np.array([len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(n)[:-1])
    mark = np.zeros(max(int(c.max()) for c in codes) + 1, bool)
    comp = np.zeros(len(ids), np.int64)
    work = 0
    left = np.argsort(ids, kind="stable")
    while len(left):
        seed, left = left[0], left[1:]
        comp[seed] = ids[seed]
        todo = [seed]
        while todo and len(left):
            x = todo.pop()
            fits = (100 * np.minimum(n[left], n[x]) >= percent * np.maximum(n[left], n[x])) & (ids[left] != ids[x])
            near = np.flatnonzero(fits)
            work += len(near) + len(left) // 50  # a look at the size costs that much less
            if work > WORK:
                return None
            near = near[(sigs[left[near]] == sigs[x]).sum(axis=1) >= need]
            if not len(near):
                continue
            mark[codes[x]] = True
            others = left[near]
            starts = np.cumsum(n[others]) - n[others]
            both = np.add.reduceat(mark[np.concatenate([codes[y] for y in others])].astype(np.int64), starts)
            mark[codes[x]] = False
            linked = near[100 * both >= percent * (n[x] + n[others] - both)]
            comp[left[linked]] = comp[seed]
            todo += left[linked].tolist()
            left = np.delete(left, linked)
    return comp


def _resolve(texts: DataFrame, percent: int) -> DataFrame:
    """texts: cluster, id, sig, text, dealt and sorted by cluster. Per document: node, comp; comp is null in clusters that were given up."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        cluster, ids = t.column("cluster").to_numpy(), t.column("id").to_numpy()
        sets = list(shingle_sets(t.column("text").chunk(0)))
        sigs = np.frombuffer(b"".join(x.as_py() for x in t.column("sig")), np.uint32).reshape(len(ids), -1)
        begins = np.flatnonzero(np.diff(cluster, prepend=cluster[0] - 1))
        comp: list[pa.Array] = []
        for a, b in zip(begins, [*begins[1:], len(ids)], strict=True):
            found = reach(ids[a:b], sets[a:b], sigs[a:b], percent)
            comp.append(pa.nulls(b - a, pa.int64()) if found is None else pa.array(found))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.concat_arrays(comp)], ["node", "comp"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tw.whole_groups(batches, 500):
            yield solve(t)

    return texts.select("cluster", "id", "sig", "text").mapInArrow(tw.tidy(stream), "node bigint, comp bigint")


def classes(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id``, ``kept``."""
    scratch = Scratch(docs.sparkSession, "near")
    rows = scratch.write(sketches(docs, id_col, text_col))
    sets = scratch.write(rows.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("m")))
    sigs = scratch.write(rows.where("key IS NOT NULL").join(sets.drop("m"), ["key", "id"]).select("id", "n", "sig").dropDuplicates(["id", "sig"]))
    banded = bands(sigs.select("id", "sig"))
    shared = scratch.write(banded.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("bucket", "lo", "m"))
    members = scratch.write(hot_join(banded, shared, ["bucket"], "m", HELD).select("bucket", "id", "lo"))
    clusters = scratch.write(components(members.select(F.col("id").alias("a"), F.col("lo").alias("b")), scratch).select(F.col("node").alias("id"), F.col("comp").alias("cluster")))
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).where("id IS NOT NULL")
    texts = scratch.write(sigs.join(clusters, "id").join(texts, "id").select("cluster", "id", "n", "sig", "text").dropDuplicates(["id", "text"]))
    large = scratch.write(texts.groupBy("cluster").agg(F.sum("n").alias("held"), F.count("*").alias("docs")).where((F.col("held") > CLUSTER) | (F.col("docs") > MEMBERS)).select("cluster"))
    small = texts.join(F.broadcast(large), "cluster", "left_anti") if _few(large) else texts.join(large, "cluster", "left_anti")
    found = scratch.write(_resolve(small.repartition("cluster").sortWithinPartitions("cluster"), percent))
    given_up = found.where("comp IS NULL").select(F.col("node").alias("id"))
    hard = scratch.write(given_up.union(clusters.join(large, "cluster", "left_semi").select("id")))
    found = found.where("comp IS NOT NULL")
    if not hard.isEmpty():
        found = found.union(_rounds(members.select("bucket", "id").join(hard, "id", "left_semi"), texts.join(hard, "id", "left_semi"), percent, scratch))
    found = scratch.write(found.groupBy("node").agg(F.min("comp").alias("comp")))
    label = sets.join(found.withColumnRenamed("node", "id"), "id", "left").select("key", F.coalesce("comp", "id").alias("comp"), "m")
    alone = rows.where("key IS NULL OR id IS NULL").select("id", "n", F.col("id").alias("comp"))
    named = rows.where("key IS NOT NULL AND id IS NOT NULL").select("id", "n", "key")
    named = hot_join(named, scratch.write(label), ["key"], "m", HELD).select("id", "n", "comp")
    return named.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept"))


def _few(df: DataFrame, most: int = 100_000) -> bool:
    return df.limit(most + 1).count() <= most


def prefixes(texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """texts: id, text. bucket, id: of each set, the shingles that are the rarest among all of these, so many that two sets as similar as asked share one of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(1))
            for lo in range(0, len(b), 100):
                part = [x for _, x in zip(range(lo, min(lo + 100, len(b))), sets, strict=False)]
                n = [len(x) for x in part]
                yield pa.RecordBatch.from_arrays([tw.as_long(np.concatenate(part)), pa.array(np.repeat(b.column(0).to_numpy()[lo : lo + 100], n))], ["bucket", "id"])

    held = scratch.write(texts.select("id", "text").mapInArrow(tw.tidy(scan), "bucket bigint, id bigint").distinct())
    often = scratch.write(held.groupBy("bucket").agg(F.count("*").alias("m")))
    ranked = hot_join(held, often, ["bucket"], "m", MEMBERS).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("m", "bucket"))).alias("s"))
    n = F.size("s")
    kept = n - F.ceil(n * percent / 100).cast("int") + 1
    return ranked.select("id", F.explode(F.slice("s", F.lit(1), kept)).alias("e")).where("e.m > 1").select("e.bucket", "id")


def _rounds(members: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """members: bucket, id. texts: id, sig, text. node, comp of those that have a link."""
    spark = members.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint")
    comp = spark.createDataFrame([], "node bigint, comp bigint")
    texts = scratch.write(texts.select("id", "sig", "text"))
    of = lambda id_, column, name: texts.select(F.col("id").alias(id_), F.col(column).alias(name))
    undone, round_ = members, 0
    while True:
        named = undone.join(comp.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp"))
        named = scratch.write(named)
        open_ = scratch.write(named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("bucket", "m"))
        rest = scratch.write(hot_join(named, open_, ["bucket"], "m", MEMBERS).drop("m"))
        if rest.isEmpty():
            break
        if round_ == EASY:
            undone, round_ = scratch.write(prefixes(texts.join(rest.select("id").distinct(), "id", "left_semi"), percent, scratch)), round_ + 1
            continue
        salt = F.pmod(F.xxhash64("id"), F.lit(4 ** max(0, round_ - 1 if round_ < EASY else round_ - EASY - 2))).alias("salt")
        leaders = rest.groupBy("bucket", salt).agg(F.min(F.struct("id", "comp")).alias("l"), F.count("*").alias("m")).groupBy("bucket").agg(F.collect_list("l").alias("l"), F.sum("m").alias("m"))
        leaders = scratch.write(leaders)
        met = hot_join(rest, leaders, ["bucket"], "m", HELD).select("bucket", "id", "comp", F.explode("l").alias("l"))
        leaders = leaders.select("bucket", F.explode("l").alias("l")).select("bucket", F.col("l.id").alias("a"))
        pairs = met.select("id", "comp", F.col("l.id").alias("a"), F.col("l.comp").alias("ca")).where("ca <> comp").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
        near = _alike(pairs.join(of("a", "sig", "sa"), "a").join(of("b", "sig", "sb"), "b").select("a", "b", "sa", "sb"), least_matches(percent)).distinct()
        found = scratch.write(_linked(near.join(of("a", "text", "ta"), "a").join(of("b", "text", "tb"), "b").select("a", "b", "ta", "tb"), percent).distinct())
        if not found.isEmpty():
            links = scratch.write(links.union(found))
            comp = scratch.write(components(links, scratch))
        undone = rest.join(leaders.select("bucket", F.col("a").alias("id")), ["bucket", "id"], "left_anti").select("bucket", "id")
        round_ += 1
    return comp


def keep_first(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the smallest id of their group, with all their columns."""
    gone = classes(docs, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("__gone"))
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs)
