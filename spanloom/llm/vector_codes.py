"""Compression of vectors to codes, one byte for each of their parts, in integers from end to end.

Components become integers (``floor(256 x)``) and vectors are cut into ``PARTS`` equal parts. Each part position has a
codebook of at most ``ENTRIES`` parts. A part is told by its nearest entry: parts and entries are padded with zeros to a
power of two and transformed by the integer Walsh-Hadamard transform in sequency order (by sign changes). The transform
keeps squared distances up to the factor of its size, and collects what is smooth in the first coefficients, so squared
differences are added up coefficient by coefficient, and an entry goes as soon as its sum is beyond the whole distance of
the entry that leads by the first coefficient. What goes can't be nearest, so codes and distances are exact.

Codebooks start as the parts of the vectors of smallest id. A round assigns all parts and moves each entry to the floor of
its parts' mean. A task sums up its parts by entry before anything is shuffled; codebooks (``ENTRIES`` times the
dimension, whatever the table's size) are all that goes through the driver.

Defined results: rows whose vector is null or holds nulls or non-finite components are dropped; components of 2^80 and more
count as non-finite. Vectors shorter than the longest, or of a length that 16 doesn't divide, are padded with zeros (an
empty vector is all zeros). Null ids are coded, but start no codebook; of rows with one id, the one with the smaller vector
comes first. With fewer vectors than entries, codebooks are smaller. Errors beyond a long are null, as are their labels' sums. An empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw
from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components times the padded part's length below which squared distances fit 64 bits; beyond, Python's integers are used.
SAFE = 1 << 28
ROWS = 4096  #: vectors that are compared at a time
HELD = 2000  #: rows of one label that a task gets in a join, but for a fixed share of a hotter label's


def sequency(size: int) -> np.ndarray:
    """The order of the Walsh-Hadamard coefficients of a power of two by sign changes."""
    h = np.ones((1, 1), int)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1))


def transform(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the last axis, padded with zeros, in the given order."""
    size = len(order)
    out = np.zeros((*x.shape[:-1], size), x.dtype)
    out[..., : x.shape[-1]] = x
    step = 1
    while step < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(out.shape)
        step *= 2
    return out[..., order]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transformed parts (n x size) and entries (k x size): the index of each part's nearest entry (the lowest of equals), and size times its squared distance."""
    lead = (x[:, :1] - entries[:, 0]) ** 2
    leader = lead.argmin(axis=1)
    bound = ((x - entries[leader]) ** 2).sum(axis=1)
    row, entry = np.nonzero(lead <= bound[:, None])
    total = lead[row, entry]
    for j in range(1, x.shape[1]):
        total = total + (x[row, j] - entries[entry, j]) ** 2
        stay = np.flatnonzero(total <= bound[row])
        row, entry, total = row[stay], entry[stay], total[stay]
    # what is left has its whole distance; the leader is always left, so each part has one
    begins = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(total, begins) if len(x) else total
    best = np.flatnonzero(total == least[row])
    first = best[np.searchsorted(row[best], np.arange(len(x)))]
    return entry[first], least


def integers(v: pa.Array, size: int) -> np.ndarray:
    """n x size: floor(SCALE x), zero beyond a vector's end; Python's integers where 64 bits could be too few."""
    flat = v.flatten().to_numpy(zero_copy_only=False)
    length = v.value_lengths().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * SCALE)
    width = 1 << max(0, (size // PARTS - 1).bit_length())
    safe = not len(scaled) or np.abs(scaled).max() * width < SAFE
    out = np.zeros((len(v), size), np.int64 if safe else object)
    place = np.arange(size) < length[:, None]
    out[place] = scaled.astype(np.int64) if safe else np.array([int(x) for x in scaled], object)
    return out


class Books:
    """A codebook for each part position."""

    def __init__(self, parts: np.ndarray):  # position x entry x component
        self.parts = parts
        self.order = sequency(1 << max(0, (parts.shape[2] - 1).bit_length()))

    def assign(self, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """By part position and stretch of vectors: position, parts, codes, squared distances."""
        positions, _, width = self.parts.shape
        exact = q.dtype == object or self.parts.dtype == object or len(self.order) * int(np.abs(self.parts).max(initial=0)) >= SAFE
        kind = object if exact else np.int64
        entries = transform(self.parts.astype(kind), self.order)
        for p in range(positions):
            for lo in range(0, len(q), ROWS):
                x = q[lo : lo + ROWS, p * width : (p + 1) * width].astype(kind)
                code, distance = nearest(transform(x, self.order), entries[p])
                yield p, x, code, distance // len(self.order)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.parts.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """id, v (array of double), label of the rows that take part."""
    label = vectors[label_col] if label_col else F.lit(None).cast("int")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v"), label.alias("label")).where("v IS NOT NULL")
    return rows.where(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(2.0**80)), F.lit(False))))


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Books | None:
    """rows: id, v."""
    seeds = rows.where("id IS NOT NULL").orderBy("id", "v").limit(ENTRIES).select("v").toArrow().column(0).combine_chunks()
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    size = max(1, -(-longest // PARTS)) * PARTS
    if len(seeds):
        start = integers(seeds, size)
    else:  # only null ids: a single entry of zeros
        start = np.zeros((1, size), np.int64)
    books = Books(start.reshape(len(start), PARTS, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _moved(rows, books, size)
    return books


def _moved(rows: DataFrame, books: Books, size: int) -> Books:
    positions, k, width = books.parts.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((positions, k, width), object), np.zeros((positions, k), np.int64)
        for b in batches:
            for p, x, code, _ in books.assign(integers(b.column(0), size)):
                own = np.zeros((k, width), x.dtype)
                np.add.at(own, code, x)
                total[p] += own.astype(object)
                count[p] += np.bincount(code, minlength=k)
        p, e = np.nonzero(count)
        if len(p):
            cell = np.repeat(p * k + e, width)
            at = np.tile(np.arange(width), len(p))
            sums = pa.array([Decimal(x) for x in total[p, e].ravel().tolist()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(at), pa.array(np.repeat(count[p, e], width)), sums], ["cell", "at", "n", "s"])

    sums = rows.select("v").mapInArrow(tw.tidy(scan), "cell bigint, at bigint, n bigint, s decimal(38,0)").groupBy("cell", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    parts = books.parts.astype(object)
    for cell, at, n, s in sums.collect():  # as many as a codebook has components
        parts[cell // k, cell % k, at] = int(s) // n
    fits = all(abs(x) * len(books.order) < SAFE for x in parts.ravel().tolist())
    return Books(parts.astype(np.int64) if fits else parts)


CODED = "id bigint, code binary, error bigint"


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """rows: id, v, label. Returns id, code (a byte for each part), error (squared distances), label."""
    positions, _, width = books.parts.shape
    kind = rows.schema["label"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, error = np.zeros((len(b), positions), np.uint8), np.zeros(len(b), object)
            done = np.zeros(positions, int)
            for p, x, code, distance in books.assign(integers(b.column(1), positions * width)):
                lo = done[p]
                codes[lo : lo + len(x), p] = code
                error[lo : lo + len(x)] += distance.astype(object)
                done[p] += len(x)
            fits = [x if x < 1 << 63 else None for x in error.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(fits, pa.int64()), b.column(2)], ["id", "code", "error", "label"])

    return rows.select("id", "v", "label").mapInArrow(tw.tidy(scan), f"{CODED}, label {kind}")


def decode(codes: DataFrame, books: Books, code_col: str = "code", out: str = "approximation") -> DataFrame:
    """Adds the vector that a code stands for, entry after entry, as doubles."""
    table = F.lit([[[float(x) / SCALE for x in e] for e in p] for p in books.parts.tolist()])
    byte = lambda p: F.conv(F.hex(F.substring(code_col, p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn(out, F.flatten(F.array(*(F.element_at(F.element_at(table, p + 1), byte(p) + 1) for p in range(len(books.parts))))))


def digest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code (hex), error, label_error (error summed over equal labels, nulls together), codebooks_sha256."""
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = usable(vectors, id_col, vector_col, label_col)
    books = fit(rows)
    coded = encode(rows, books) if books else rows.select("id", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"), "label")
    none, name = F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name")
    coded = scratch.write(coded.select("id", F.lower(F.hex("code")).alias("code"), "error", none, name))
    sums = coded.groupBy("none", "name").agg(F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)"))).alias("total"), F.count("*").alias("m"))
    sums = scratch.write(sums.select("none", "name", F.expr("try_cast(total AS bigint)").alias("label_error"), "m"))
    return hot_join(coded, sums, ["none", "name"], "m", HELD).select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256() if books else "").alias("codebooks_sha256"))
