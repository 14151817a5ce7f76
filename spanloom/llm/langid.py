"""Language identification by nearest centroid.

A text becomes a vector of hashed byte n-grams (two to four bytes; letters lower-cased, all else a single space),
weighted by TF-IDF and normalised. Document frequencies are counted over all training rows. Per language, a bounded
sample is clustered into several centroids (``FIT_DOCS`` rows in all, a documented bound; the rest of the model has a
fixed size). A text gets the language of the centroid with the largest cosine; ``rejected`` marks cosines below almost
all of those seen in training.

Defined results: null texts and texts without a letter get ``und`` and score 0; a text whose letters give no known
n-gram gets the most frequent training language; without training rows all get ``und``; repeated rows repeat their
result; an empty table gives an empty table; other columns are ignored. Texts are taken whole, slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw

D = 4096
FIT_DOCS = 3000
CLUSTERS = 3
REJECT = 0.001
SHARP = 25.0
_NORMAL = tw._byte_table(lambda b: tw.LOWER[b] if b >= 0x80 or chr(b).isalpha() else 0x20).astype(np.uint8)
_LETTER = tw._byte_table(lambda b: b < 0x80 and chr(b).isalpha())
_ROWS = 128


class Model(NamedTuple):
    langs: list[str]  #: of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: float
    prior: str | None


def counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For up to ``_ROWS`` rows at a time: n-gram counts, and whether the row has a letter."""
    for s in tw.slices(column, 1 << 18):
        for lo in range(0, s.hi - s.lo, _ROWS):
            off = s.offsets[lo : lo + _ROWS + 1]
            raw = s.data[off[0] : off[-1]]
            off = off - off[0]
            n = len(off) - 1
            letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])[off]
            has = np.diff(letters) > 0
            for r in np.flatnonzero(~has):
                part = raw[off[r] : off[r + 1]]
                has[r] = bool(len(part)) and int(part.max()) >= 0x80 and any(map(str.isalpha, part.tobytes().decode("utf-8", "replace")))
            data = _NORMAL[raw]
            row = np.repeat(np.arange(n), np.diff(off))
            space = data == 0x20
            keep = np.ones(len(data), bool)
            keep[1:] = ~(space[1:] & space[:-1] & (row[1:] == row[:-1]))
            data, row = data[keep].astype(np.uint32), row[keep]
            out = np.zeros(n * D, np.int64)
            code = data
            for k in (2, 3, 4):
                if len(data) < k:
                    break
                code = (code[: len(data) - k + 1] << np.uint32(8)) | data[k - 1 :]
                bucket = ((code * np.uint32(0x9E3779B1) + np.uint32(k)) * np.uint32(0x85EBCA6B)) >> np.uint32(20)
                whole = row[: len(code)] == row[k - 1 :]
                out += np.bincount((row[: len(code)] * D + bucket)[whole], minlength=n * D)
            yield out.reshape(n, D), has


def weigh(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(c.astype(np.float32)) * idf
    size = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(size > 0, size, 1)[:, None]


def _cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with a farthest-first start."""
    centres = [v.mean(axis=0)]
    while len(centres) < min(k, len(v)):
        centres.append(v[np.argmin((v @ np.array(centres).T).max(axis=1))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (v @ (centres / np.maximum(np.linalg.norm(centres, axis=1), 1e-9)[:, None]).T).argmax(axis=1)
        centres = np.array([v[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1), 1e-9)[:, None]


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS, clusters: int = CLUSTERS) -> Model:
    rows = train.select(train[id_col].alias("id"), train[text_col].cast("string").alias("text"), train[lang_col].cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, langs = np.zeros(D, np.int64), 0, {}
        for b in batches:
            for c, _ in counts(b.column(0)):
                df += (c > 0).sum(axis=0)
                n += len(c)
            for x in b.column(1).value_counts().to_pylist():
                langs[x["values"]] = langs.get(x["values"], 0) + x["counts"]
        yield pa.RecordBatch.from_arrays([pa.array([*map(str, range(D)), "n", *("=" + x for x in langs)], pa.string()), pa.array([*df.tolist(), n, *langs.values()], pa.int64())], ["key", "n"])

    totals = {r["key"]: r["n"] for r in rows.select("text", "lang").mapInArrow(seen, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    n = totals.get("n", 0)
    idf = np.log((n + 1) / (np.array([totals.get(str(i), 0) for i in range(D)]) + 1)).astype(np.float32) + np.float32(0.01)
    langs = sorted(((x[1:], c) for x, c in totals.items() if x[0] == "="), key=lambda x: (-x[1], x[0]))
    if not langs:
        return Model([], np.zeros((0, D), np.float32), idf, 0.0, None)
    share = F.create_map(*[F.lit(y) for x, c in langs for y in (x, min(1.0, fit_docs / len(langs) / c))])
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000).select("text", "lang")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [x.tobytes() for c, _ in counts(b.column(0)) for x in weigh(c, idf)]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()), b.column(1)], ["v", "lang"])

    sample = drawn.mapInArrow(vectors, "v binary, lang string").limit(2 * fit_docs).toPandas()
    names, centroids, best = [], [], []
    for lang, _ in langs:
        v = [np.frombuffer(x, np.float32) for x in sample["v"][sample["lang"] == lang]]
        if v:
            v = np.array(v)
            c = _cluster(v, clusters)
            centroids.append(c)
            names += [lang] * len(c)
            best.append((v @ c.T).max(axis=1))
    if not names:
        return Model([], np.zeros((0, D), np.float32), idf, 0.0, langs[0][0])
    return Model(names, np.concatenate(centroids).astype(np.float32), idf, float(np.quantile(np.concatenate(best), REJECT)), langs[0][0])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred``, ``score`` (0 to 1), ``cosine`` and ``rejected``."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = sorted(set(m.langs), key=m.langs.index)
        of = [np.array([x == y for x in m.langs]) for y in names]
        for b in batches:
            langs, scores, cosines = [], [], []
            for c, has in counts(b.column(1)):
                if not names:
                    langs += ["und"] * len(c)
                    scores += [0.0] * len(c)
                    cosines += [0.0] * len(c)
                    continue
                cos = weigh(c, m.idf) @ m.centroids.T
                per = np.stack([cos[:, x].max(axis=1) for x in of], axis=1).astype(np.float64)
                odds = np.exp(SHARP * (per - per.max(axis=1, keepdims=True)))
                top = per.argmax(axis=1)
                top[~c.any(axis=1)] = 0
                langs += [names[t] if h else "und" for t, h in zip(top, has, strict=True)]
                scores += np.where(has, odds.max(axis=1) / odds.sum(axis=1), 0.0).tolist()
                cosines += np.where(has, np.clip(per.max(axis=1), 0, 1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(cosines, pa.float64()), pa.array([x < m.floor for x in cosines], pa.bool_())], ["id", "lang_pred", "score", "cosine", "rejected"])

    return rows.mapInArrow(scan, f"id {kind}, lang_pred string, score double, cosine double, rejected boolean").withColumnRenamed("id", id_col)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the contract; rows whose crc32(doc_id) mod 4 is 2 are held out from all learning."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit(docs.select("doc_id", "text", "lang").where(fold != 2))
    return predict(docs, model).select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
