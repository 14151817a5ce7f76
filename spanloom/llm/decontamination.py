"""Benchmark decontamination by winnowing.

Every benchmark item is cut into windows of ``span`` words; a document word inside any occurrence of a window is hit.
Both sides keep, of each ``span - K + 1`` consecutive K-gram hashes, the smallest. A shared run of ``span`` words holds
the same such K-grams on both sides and selects the same one, so each occurrence shows up in the join of fingerprints;
each joined pair is extended word by word, and counts only if a whole window agrees. Items shorter than ``span`` are one
window each, which winnowing doesn't guarantee; these windows are looked up at every document position, by length.

Words are compared by 64-bit hashes, all words of a window at once.

A benchmark of at most ``BLOCK_WORDS`` words (counted by Spark before anything is fetched) travels to the tasks as one
``Block``, and documents are scanned once without a shuffle. A larger one stays in Spark (``_joined``): its fingerprints
are a table, a bitmap of fixed size tells the scan of the documents which fingerprints may be among them, those are
written with the words around them, joined with the table by hash, and each pair is extended.

Defined results: null and empty texts have no words and no hits; null item ids and empty items are left out, items with
the same id count once; repeated documents repeat their result; an empty table on either side gives no hits; other
columns are ignored (``hits``) or passed on (``drop_contaminated``). Very frequent passages cost each document that has
them its own hits only: no two documents are ever paired. Texts are taken whole, slice by slice; a very long one is a slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw
from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

K = 5
BLOCK_WORDS = 2_000_000
HELD = 2000  #: documents of one fingerprint that a task gets, but for a fixed share of a hotter one's
BITS = 1 << 27  #: of the bitmap, 16 MB


class Block:
    """Fingerprints of some benchmark items, for lookups."""

    def __init__(self, ids: list[str], texts: list[str], span: int):
        self.span, self.ids = span, np.array(ids, object)
        self.k = min(K, max(2, span // 2))
        hashes, items = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.n_words = 0
        for s in tw.slices(pa.array(texts, pa.string())):
            w = tw.words(s, tw.ALNUM, lower=True)
            hashes.append(w.hash)
            items.append(tw.row_of(w.first) + s.lo)
            self.n_words += len(w.hash)
        self.hash, self.item = np.concatenate(hashes), np.concatenate(items)
        size = np.bincount(self.item, minlength=len(ids)) if len(ids) else np.zeros(0, np.int64)
        at, gram = tw.grams(self.hash, self.item, self.k)
        picked = tw.winnow(at, gram, span - self.k + 1)
        order = np.argsort(gram[picked], kind="stable")
        self.gram, self.gram_at = gram[picked][order], at[picked][order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(size[(size > 0) & (size < span)]):
            at, gram = (np.arange(len(self.hash)), tw.mix(self.hash)) if n == 1 else tw.grams(self.hash, self.item, int(n))
            mine = size[self.item[at]] == n
            order = np.argsort(gram[mine], kind="stable")
            self.short[int(n)] = gram[mine][order], self.item[at[mine]][order]

    @staticmethod
    def _pairs(keys: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of ``found`` and of the sorted ``keys`` that are equal."""
        if not len(keys) or not len(found):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo = np.searchsorted(keys, found, "left")
        some = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == found)
        lo, hi = lo[some], np.searchsorted(keys, found[some], "right")
        n = hi - lo
        return np.repeat(some, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def match(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of windows: first word, number of words, and index of the item."""
        starts, lengths, items = [], [], []
        at, gram = tw.grams(hashes, rows, self.k)
        picked = tw.winnow(at, gram, self.span - self.k + 1)
        mine, theirs = self._pairs(self.gram, gram[picked])
        if len(mine):
            d, b = at[picked][mine], self.gram_at[theirs]
            before = self.span - self.k
            same = np.zeros((len(d), 2 * before + self.k), bool)
            for j in range(-before, before + self.k):
                i, k = np.clip(d + j, 0, len(hashes) - 1), np.clip(b + j, 0, len(self.hash) - 1)
                same[:, j + before] = (d + j == i) & (b + j == k) & (rows[i] == rows[d]) & (self.item[k] == self.item[b]) & (hashes[i] == self.hash[k])
            run = np.concatenate([np.zeros((len(d), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
            for j in range(before + 1):
                whole = run[:, j + self.span] - run[:, j] == self.span
                starts.append(d[whole] + j - before)
                items.append(self.item[b[whole]])
                lengths.append(np.full(whole.sum(), self.span))
        for n, (keys, of) in self.short.items():
            at, gram = (np.arange(len(hashes)), tw.mix(hashes)) if n == 1 else tw.grams(hashes, rows, n)
            mine, theirs = self._pairs(keys, gram)
            starts.append(at[mine])
            items.append(of[theirs])
            lengths.append(np.full(len(mine), n))
        return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (starts, lengths, items))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, text: one row an id."""
    rows = benchmark.select(benchmark[id_col].cast("string").alias("item"), benchmark[text_col].cast("string").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    return rows.dropDuplicates(["item", "text"])


def block(items: DataFrame, span: int) -> Block | None:
    """The whole benchmark, if it has no more than ``BLOCK_WORDS`` words."""
    # each word but the last has a byte that parts it from the next
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") / 2 + 1), F.lit(0)), F.count("*")).first()
    if size[0] > BLOCK_WORDS:
        return None
    rows = items.collect()
    return Block([r["item"] for r in rows], [r["text"] for r in rows], span)


def _judge(column: pa.Array, block: Block) -> Iterator[tuple[int, list, list]]:
    """By row: number of words, hit runs (first, end), ids of items."""
    for s in tw.slices(column):
        w = tw.words(s, tw.ALNUM, lower=True)
        rows, counts = tw.row_of(w.first), np.diff(w.first)
        start, length, item = block.match(w.hash, rows)
        if not len(start):
            yield from ((int(n), [], []) for n in counts)
            continue
        delta = np.zeros(len(w.hash) + 1, np.int64)
        np.add.at(delta, start, 1)
        np.add.at(delta, start + length, -1)
        covered = np.concatenate([[False], np.cumsum(delta[:-1]) > 0, [False]])
        begins, ends = covered[1:-1] & ~covered[:-2], covered[1:-1] & ~covered[2:]
        cuts = w.first[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(w.hash))]
        begins[cuts] = covered[1:-1][cuts]
        ends[cuts - 1] = covered[1:-1][cuts - 1]
        first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        runs: dict[int, list] = {}
        for r, a, b in zip(rows[first].tolist(), (first - w.first[rows[first]]).tolist(), (end - w.first[rows[first]]).tolist(), strict=True):
            runs.setdefault(r, []).append({"first": a, "end": b})
        found: dict[int, set] = {}
        pairs = np.unique(rows[start] * np.int64(len(block.ids)) + item)
        for r, i in zip((pairs // len(block.ids)).tolist(), (pairs % len(block.ids)).tolist(), strict=True):
            found.setdefault(r, set()).add(block.ids[i])
        yield from ((int(n), runs.get(r, []), sorted(found.get(r, ()))) for r, n in enumerate(counts))


def hits(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (arrays of first and end word of each hit run) and ``items`` (sorted ids)."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def scanned(block: Block, rows: DataFrame) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = list(_judge(b.column(1), block))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], run), pa.array([x[2] for x in got], pa.list_(pa.string()))], ["id", "n_words", "runs", "items"])

        return rows.mapInArrow(scan, f"id {kind}, n_words bigint, runs array<struct<first:bigint,end:bigint>>, items array<string>")

    items = _items(benchmark, item_col, item_text_col)
    whole = block(items, span)
    if whole is not None:
        return scanned(whole, rows).withColumnRenamed("id", id_col)
    return _joined(rows, items, span).drop("h").withColumnRenamed("id", id_col)


# -- benchmarks of any size

#: A window's k-gram hash (or that of a short item, mixed with its length), where it starts, how many of the words around it precede it, and those words' hashes.
MARK = "g bigint, at bigint, nl int, words binary"


class Marks(NamedTuple):
    """What a task knows to make fingerprints: the span, and the lengths of items that are shorter."""

    span: int
    short: list[int]

    @property
    def k(self) -> int:
        return min(K, max(2, self.span // 2))

    def of(self, column: pa.Array, item_side: bool, bitmap: np.ndarray | None = None) -> Iterator[tuple[int, list[list]]]:
        """By row: its number of words, and the four columns of its marks. bitmap: marks that it lacks are left out."""
        before = self.span - self.k
        for s in tw.slices(column):
            w = tw.words(s, tw.ALNUM, lower=True)
            rows, size = tw.row_of(w.first), np.diff(w.first)
            at, gram = tw.grams(w.hash, rows, self.k)
            picked = tw.winnow(at, gram, before + 1)
            found = [(at[picked], gram[picked], before, before + self.k)]
            for n in self.short:
                at, gram = (np.arange(len(w.hash)), tw.mix(w.hash)) if n == 1 else tw.grams(w.hash, rows, n)
                fits = size[rows[at]] == n if item_side else np.ones(len(at), bool)
                found.append((at[fits], tw.mix(gram[fits] ^ np.uint64(n)), 0, n))
            where, grams = np.concatenate([f[0] for f in found]).astype(np.int64), np.concatenate([f[1] for f in found])
            lo = np.concatenate([np.maximum(f[0] - f[2], w.first[rows[f[0]]]) for f in found]).astype(np.int64)
            hi = np.concatenate([np.minimum(f[0] + f[3], w.first[rows[f[0]] + 1]) for f in found]).astype(np.int64)
            if bitmap is not None:
                bit = grams % np.uint64(BITS)
                keep = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
                where, grams, lo, hi = where[keep], grams[keep], lo[keep], hi[keep]
            order = np.argsort(where, kind="stable")
            where, grams, lo, hi = where[order], grams[order].view(np.int64), lo[order], hi[order]
            cut = np.searchsorted(where, w.first)
            raw = w.hash.tobytes()
            for r in range(s.hi - s.lo):
                a, b = cut[r], cut[r + 1]
                words = [raw[8 * x : 8 * y] for x, y in zip(lo[a:b].tolist(), hi[a:b].tolist(), strict=True)]
                yield int(size[r]), [grams[a:b].tolist(), (where[a:b] - w.first[r]).tolist(), (where[a:b] - lo[a:b]).tolist(), words]


def _joined(rows: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """rows: id, text. As ``hits``, for a benchmark that no task need hold."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "decontamination")
    mark = pa.struct([("g", pa.int64()), ("at", pa.int64()), ("nl", pa.int32()), ("words", pa.binary())])

    def columns(found: list[list[list]]) -> pa.Array:
        ends = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
        parts = [pa.array([x for f in found for x in f[i]], mark.field(i).type) for i in range(4)]
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(parts, fields=list(mark)))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = {int(n) for s in tw.slices(b.column(0)) for n in np.diff(tw.words(s, tw.ALNUM, lower=True).first) if 0 < n < span}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(n), pa.int32())], ["n"])

    short = sorted(r["n"] for r in items.select("text").mapInArrow(lengths, "n int").distinct().collect())  # fewer than span
    marks = Marks(span, short)

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), columns([f for _, f in marks.of(b.column(1), True)])], ["item", "marks"])

    theirs = items.mapInArrow(of_items, f"item string, marks array<struct<{MARK.replace(' ', ':').replace(',:', ',')}>>")
    theirs = scratch.write(theirs.select("item", F.explode("marks").alias("m")).select("item", "m.*"))
    bit = F.pmod("g", F.lit(BITS))  # divides 2**64, so the sign doesn't matter
    # a word of 64 bits where there is any: at most BITS / 64 rows, whatever the benchmark
    held = theirs.select(bit.alias("b")).groupBy((F.col("b") / 64).cast("long").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(b % 64 AS INT))")).alias("w")).toPandas()
    held = spark.sparkContext.broadcast((held["at"].to_numpy(np.int64), held["w"].to_numpy(np.int64)))

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(BITS // 64, np.uint64)
        bitmap[held.value[0]] = held.value[1].view(np.uint64)
        for b in batches:
            found = list(marks.of(b.column(2), False, bitmap))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([n for n, _ in found], pa.int64()), columns([f for _, f in found])], ["id", "h", "n_words", "marks"])

    keyed = rows.select("id", F.xxhash64("text").alias("h"), "text")
    ours = scratch.write(keyed.mapInArrow(of_documents, f"id {rows.schema['id'].dataType.simpleString()}, h bigint, n_words bigint, marks array<struct<{MARK.replace(' ', ':').replace(',:', ',')}>>"))
    key = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key")  # rows of one id and text are alike
    mine = ours.where(F.size("marks") > 0).select(key, "h", "marks").dropDuplicates(["key", "h"])
    mine = mine.select("key", "h", F.explode("marks").alias("m")).select("key", "h", "m.*")
    often = scratch.write(mine.groupBy("g").agg(F.count("*").alias("m")))
    theirs = scratch.write(theirs.select("g", "item", F.col("nl").alias("nl2"), F.col("words").alias("words2")).join(often, "g"))
    # a frequent fingerprint's documents are dealt over tasks
    pairs = hot_join(mine, theirs, ["g"], "m", HELD).select("key", "h", "at", "nl", "words", "item", "nl2", "words2")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            ctx = zip(*(b.column(i).to_pylist() for i in range(8)), strict=True)
            for doc, h, at, nl, words, item, nl2, words2 in ctx:
                x, y = np.frombuffer(words, np.uint64), np.frombuffer(words2, np.uint64)
                back = min(nl, nl2)  # from the first word that both have
                x, y = x[nl - back :], y[nl2 - back :]
                n = min(len(x), len(y))
                same = np.concatenate([[0], np.cumsum(x[:n] == y[:n])])
                width = min(span, len(words2) // 8)  # an item with fewer words is one window
                for s in np.flatnonzero(same[width:] - same[: n + 1 - width] == width) if n >= width else ():
                    for column, value in zip(out, (doc, h, at - back + int(s), at - back + int(s) + width, item), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["key", "h", "first", "end", "item"])

    met = pairs.mapInArrow(tw.tidy(extend), "key string, h bigint, first bigint, end bigint, item string")
    met = met.groupBy("key", "h").agg(F.collect_set(F.struct("first", "end")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    run = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = []
            for spans in b.column(2).to_pylist():
                own: list[dict] = []
                for s in sorted(spans, key=lambda s: s["first"]):
                    if own and s["first"] <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], s["end"])
                    else:
                        own.append(s)
                runs.append(own)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(runs, run), b.column(3)], ["key", "h", "runs", "items"])

    kept = "array<struct<first:bigint,end:bigint>>"
    met = scratch.write(met.mapInArrow(merge, f"key string, h bigint, runs {kept}, items array<string>"))
    out = ours.select("id", "h", "n_words", key).join(met, ["key", "h"], "left")
    return out.select("id", "n_words", F.coalesce("runs", F.array().cast(kept)).alias("runs"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "h")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows without any hit, with all their columns."""
    items = _items(benchmark, item_col, item_text_col)
    whole = block(items, span)
    if whole is None:
        rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
        gone = _joined(rows, items, span).where(F.size("runs") > 0).select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("__key"), F.col("h").alias("__h")).distinct()
        same = (F.coalesce(docs[id_col].cast("string"), F.lit("")) == F.col("__key")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("__h"))
        return docs.join(gone, same, "left_anti")
    at = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not runs for _, runs, _ in _judge(b.column(at), whole)], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of the contract, derived from ``hits``."""
    found = hits(docs, benchmark)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = []
            for runs in b.column(2).to_pylist():
                n = end = 0
                for a, z in sorted((r["first"], r["end"]) for r in runs):
                    n += max(0, z - max(a, end))
                    end = max(end, z)
                hit.append(n)
            items = b.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()), pa.array([n > 0 for n in hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.mapInArrow(scan, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")
