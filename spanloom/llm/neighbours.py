"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to unit length and cut in two halves, and each half is quantised by its own codebook, so a vector lies
in one of K x K cells. A query walks the cells by the sum of its two halves' squared distances, taken from a heap in
rising order, until the visited cells hold enough entries. The entries of those cells are reranked by their exact cosine in
double precision.

How many entries are enough is measured, not set: one scan of the index finds the true neighbours of ``CALIBRATE`` of its
vectors, and the walk goes as far as ``recall`` of these ask for. On vectors with clusters that is a small number whatever
the size of the index; on vectors without any structure it is a large share of them, as no such index can do better.

Codebooks are fitted on a bounded sample (``FIT_ROWS`` vectors, a documented bound); every vector is indexed. K grows with
the root of the index's size up to ``MOST_CENTRES``. Equal vectors are one entry, which keeps the k + 1 smallest ids: no
more can be among a query's k nearest. They are combined batch by batch before the shuffle, so a vector that a third of all
rows share stays one small entry.

Reranking joins blocks: entries by first centroid (split at random beyond ``BLOCK_ROWS``) with the queries that visit
it, themselves split into blocks. A task holds one block of each and returns each query's best of it.

Defined results: vectors null, of zero length, or with null or non-finite components take no part; neither do null ids
and vectors of another length than the most frequent; ties go to the smaller id; an id that occurs twice with the same
vector counts once; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.session import Scratch

FIT_ROWS = 65_536
MOST_CENTRES = 1024  #: of a codebook, so that there are at most a million cells
CALIBRATE = 300
BLOCK_ROWS = 20_000
FOUND = "query_id bigint, rank int, vec_id bigint, score double"


class Codebooks(NamedTuple):
    left: np.ndarray
    right: np.ndarray


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and v (array of double) of the rows that take part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))).where(F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: v (binary of doubles) and its k smallest ids."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if len(ids) else np.zeros((0, 1))
            by: dict[bytes, list[int]] = {}
            for i in np.argsort(ids, kind="stable"):
                own = by.setdefault((flat[i] + 0.0).tobytes(), [])
                if len(own) < k and ids[i] not in own:
                    own.append(int(ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.binary()), pa.array(list(by.values()), pa.list_(pa.int64()))], ["v", "ids"])

    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k)
    return rows.mapInArrow(combine, "v binary, ids array<bigint>").groupBy("v").agg(smallest.alias("ids"))


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
    x = x / np.where(big > 0, big, 1)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([_distances(x[lo : lo + 4096], centres).argmin(axis=1) for lo in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def _sample(found: DataFrame, n: int, most: int) -> np.ndarray:
    """At most so many of the n entries' vectors, by hash order."""
    place = F.pmod(F.xxhash64("v"), F.lit(1_000_000))
    drawn = found.where(place <= min(1.0, 2 * most / n) * 1_000_000).select("v").orderBy(F.xxhash64("v", F.lit(1))).limit(most).toPandas()["v"]
    if not len(drawn):
        drawn = found.select("v").limit(most).toPandas()["v"]
    return np.array([np.frombuffer(v) for v in drawn])


def fit(found: DataFrame, n: int, fit_rows: int = FIT_ROWS) -> Codebooks | None:
    """found: entries; n: how many there are."""
    if not n:
        return None
    k = int(min(MOST_CENTRES, max(4, 2 ** round(math.log2(math.sqrt(n) / 3 + 1)))))
    x = _unit(_sample(found, n, min(fit_rows, max(16_384, 64 * k))))
    half, rng = max(1, x.shape[1] // 2), np.random.default_rng(11)
    return Codebooks(_codebook(x[:, :half], k, rng), _codebook(x[:, half:], k, rng))


def walk(left: np.ndarray, right: np.ndarray, held: np.ndarray, enough: int) -> dict[int, list[int]]:
    """Cells in rising order of left[i] + right[j], until they hold enough; by i, the js. held: entries by cell."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, got = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}, 0
    out: dict[int, list[int]] = {}
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        n = int(held[a[i], b[j]])
        if n:
            out.setdefault(int(a[i]), []).append(int(b[j]))
            got += n
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return out


def enough_for(placed: DataFrame, books: Codebooks, held: np.ndarray, k: int, recall: float) -> int:
    """How many entries a walk has to visit, so that this share of true neighbours is among them. placed: v, i, j.

    The neighbours are those of ``CALIBRATE`` entries, found by one scan that keeps the nearest seen of each.
    """
    n = int(held.sum())
    if recall >= 1:
        return n
    own = _sample(placed, n, CALIBRATE)
    asked = _unit(own)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(asked)
        for b in batches:
            if not len(b):
                continue
            x = np.array([np.frombuffer(v.as_py()) for v in b.column(0)])
            cell = b.column(1).to_numpy().astype(np.int64) << 32 | b.column(2).to_numpy()
            cos = asked @ _unit(x).T
            for q in range(len(asked)):
                top = np.argpartition(-cos[q], k)[: k + 1] if len(x) > k + 1 else np.arange(len(x))
                top = top[~(x[top] == own[q]).all(axis=1)]
                c, at = np.concatenate([best[q][0], cos[q][top]]), np.concatenate([best[q][1], cell[top]])
                keep = np.argsort(-c, kind="stable")[:k]
                best[q] = c[keep], at[keep]
        q = np.repeat(np.arange(len(asked)), [len(c) for c, _ in best])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([c for c, _ in best])), pa.array(np.concatenate([at for _, at in best]))], ["q", "c", "cell"])

    found = placed.select("v", "i", "j").mapInArrow(nearest, "q bigint, c double, cell bigint")
    found = found.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("c"), "cell"))), 1, k).alias("best"))  # k a partition
    half, needs = books.left.shape[1], []
    for r in found.collect():  # CALIBRATE rows at most
        q = asked[r["q"]]
        sums = _distances(q[None, :half], books.left)[0][:, None] + _distances(q[None, half:], books.right)[0]
        needs += [int(held[sums <= sums[x["cell"] >> 32, x["cell"] & 0xFFFFFFFF]].sum()) for x in r["best"]]
    return sorted(needs)[min(len(needs) - 1, math.ceil(recall * len(needs)))] if needs else n


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest found of each query, never its own id: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    index = scratch.write(entries(usable(vectors, id_col, vector_col), k + 1))
    n = index.count()
    books = fit(index, n)
    if books is None:
        return spark.createDataFrame([], FOUND)
    half = books.left.shape[1]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(np.array([np.frombuffer(v.as_py()) for v in b.column(0)]).reshape(len(b), -1)) if len(b) else np.zeros((0, 2 * half))
            i, j = _distances(x[:, :half], books.left).argmin(axis=1), _distances(x[:, half:], books.right).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())], ["v", "ids", "i", "j"])

    placed = scratch.write(index.mapInArrow(cells, "v binary, ids array<bigint>, i int, j int"))
    held = np.zeros((len(books.left), len(books.right)), np.int64)
    for r in placed.groupBy("i", "j").count().collect():  # K x K rows at most
        held[r["i"], r["j"]] = r["count"]
    enough = enough_for(placed, books, held, k, recall)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            raw = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if ids else np.zeros((0, 2 * half))
            x = _unit(raw)
            if x.shape[1] != half + books.right.shape[1]:
                continue
            left, right = _distances(x[:, :half], books.left), _distances(x[:, half:], books.right)
            for lo in range(0, len(ids), 200):
                out = [(ids[r], raw[r].tobytes(), js, i) for r in range(lo, min(lo + 200, len(ids))) for i, js in walk(left[r], right[r], held, enough).items()]
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32()), strict=True)], ["q", "qv", "js", "i"])

    asked = usable(queries, id_col, vector_col).repartition(max(2, spark.sparkContext.defaultParallelism), "id")
    asking = scratch.write(asked.mapInArrow(visits, "q bigint, qv binary, js array<int>, i int"))
    visited = {r["i"]: r["count"] for r in asking.groupBy("i").count().collect()}  # K rows at most
    sizes = [(i, max(1, -(-int(m) // BLOCK_ROWS)), max(1, -(-visited.get(i, 0) // BLOCK_ROWS))) for i, m in enumerate(held.sum(axis=1))]
    sizes = F.broadcast(spark.createDataFrame(sizes, "i int, parts int, q_parts int"))
    asking = asking.join(sizes, "i").withColumn("q_part", F.pmod(F.xxhash64("q"), F.col("q_parts")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = placed.join(sizes, "i").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).withColumn("q_part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)))

    def rerank(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(block) and len(asking):
            block = block.sort_values("j", kind="stable")
            x, j = np.array([np.frombuffer(v) for v in block["v"]]), block["j"].to_numpy()
            size = np.array([np.linalg.norm(r) for r in x])
            ids = block["ids"].tolist()
            for q, qv, js in zip(asking["q"], asking["qv"], asking["js"], strict=True):
                js = np.sort(np.asarray(js))
                lo, hi = np.searchsorted(j, js, "left"), np.searchsorted(j, js, "right")
                mine = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
                y = np.frombuffer(qv)
                cos = x[mine] @ y / (size[mine] * np.linalg.norm(y))
                top = mine[cos >= np.partition(cos, -(k + 1))[-(k + 1)]] if len(mine) > k + 1 else mine  # with ties; an own copy may be the first
                best = sorted((-float(x[t] @ y / (size[t] * np.linalg.norm(y))), int(v)) for t in top for v in ids[t] if v != q)[:k]
                out.append(pd.DataFrame({"query_id": q, "vec_id": [v for _, v in best], "score": [-s for s, _ in best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    key = ["i", "part", "q_part"]
    blocks, asking = blocks.select(*key, "v", "ids", "j"), asking.select(*key, "q", "qv", "js")
    found = blocks.groupBy(*key).cogroup(asking.groupBy(*key)).applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
    ranked = found.distinct().groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("rank", "b")).select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))


def digest(vectors: DataFrame) -> DataFrame:
    return search(vectors, vectors.where(vectors["vec_id"] % 50 == 0))
