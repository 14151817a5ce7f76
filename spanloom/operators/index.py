"""An index of token positions by field and value, and lookups of token sequences in it.

A task cuts the sentences that it reads into blocks of about ``BLOCK`` tokens and numbers them within their block. For each
field, value and block there is one row: how many positions it has, and the positions (sentence within the block, token within
the sentence) as differences of the fewest bytes that hold them. Rows are in folders by field and by a hash of the value, sorted
by value, so a lookup reads the files of its values only. A frequent value has a row in every block, so no list grows with the
corpus. Keys of a block's sentences are a row without a field. All rows are written where sentences were read: nothing is
shuffled and nothing but the index is written, in a file for each folder and task.

A lookup gathers the lists of its steps by block and intersects them there: a step's lists of several fields, then each
step with the one before, at any distance in its gap. Sequences never cross a sentence.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.relation import BadData, col
from spanloom.sources.corpus import KEYS, Corpus, gathered

BLOCK = 1_000_000  #: tokens of a block, about
PARTS = 256  #: folders of a field, by hash of value
TOGETHER = 64  #: blocks whose lists of a value may share a file
#: n, sents and toks: of a list, or of a block its sentences and, as sents, their numbers; texts, ends and paras only of a block: ids of its texts, where their sentences end, numbers of paragraphs.
LIST = [("field", pa.string()), ("value", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("sents", pa.binary()), ("toks", pa.binary()), ("texts", pa.list_(pa.string())), ("ends", pa.binary()), ("paras", pa.binary())]
MADE = "value string, block bigint, n bigint, sents binary, toks binary, texts array<string>, ends binary, paras binary, field string"
LISTS = f"{MADE}, part int, run int"
KEYS_OF = ("texts", "ends", "paras")


class Step(NamedTuple):
    """A token: for each field a value, several values, or a condition on the column ``value`` (SQL, as ``Where``); and how many tokens may stand between it and the step before."""

    fields: Mapping[str, str | Sequence[str] | Where]
    gap: tuple[int, int] = (0, 0)


class Where(NamedTuple):
    condition: str


def _part(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(PARTS)).cast("int")


def packed(x: np.ndarray) -> bytes:
    """Differences of rising numbers, after a byte that tells their width."""
    step = np.diff(x, prepend=0)
    width = next(w for w in (1, 2, 4, 8) if int(step.max(initial=0)) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + step.astype(f"<u{width}").tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64))


def packed_all(x: np.ndarray, begins: np.ndarray) -> pa.Array:
    """``packed`` for each stretch of x, all at once. begins: where stretches begin."""
    step = np.diff(x, prepend=0)
    step[begins] = x[begins]
    n = np.diff(begins, append=len(x))
    most = np.maximum.reduceat(step, begins)
    width = np.select([most < 1 << 8, most < 1 << 16, most < 1 << 32], [1, 2, 4], 8)
    ends = np.cumsum(1 + n * width)
    data = np.zeros(int(ends[-1]), np.uint8)
    data[ends - n * width - 1] = width
    of, place = np.repeat(width, n), np.repeat(ends - n * width, n) + np.repeat(width, n) * (np.arange(len(x)) - np.repeat(begins, n))
    for w in (1, 2, 4, 8):
        own = of == w
        data[place[own][:, None] + np.arange(w)] = step[own].astype(f"<u{w}").view(np.uint8).reshape(-1, w)
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(data)])


def narrow(x: np.ndarray) -> bytes:
    """Numbers as they are, after a byte that tells their width."""
    width = 8 if int(x.min(initial=0)) < 0 else next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + x.astype(f"<{'i' if width == 8 else 'u'}{width}").tobytes()


def widened(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<{'i' if x[0] == 8 else 'u'}{x[0]}", offset=1).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sentences (with toks) in tables of ``BLOCK`` tokens at most, or of one sentence."""
    held, n = [], 0
    for b in batches:
        ends, at = np.cumsum(pc.list_value_length(b.column("toks")).fill_null(0).to_numpy(zero_copy_only=False)), 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, before + BLOCK - n, "right")), at if n else at + 1)
            if to > at:
                held.append(b.slice(at, to - at))
                n += int(ends[to - 1]) - before
            if to < len(ends):
                yield pa.Table.from_batches(held)
                held, n = [], 0
            at = to
    if held:
        yield pa.Table.from_batches(held)


def build(tokens: DataFrame | Corpus, path: str, fields: Sequence[str]) -> None:
    """tokens: as in a corpus; ids of texts become strings. Writes ``path``/lists; nothing is overwritten. A null is a value of no list.

    Sentences become lists in the task that has them: neither tokens nor lists are shuffled or written twice.
    """
    keys = KEYS["sentence"]
    rows = tokens.tokens if isinstance(tokens, Corpus) else tokens
    if off := [f for f in fields if f not in rows.columns]:
        raise BadData(f"no such fields: {off}")
    values = [F.col("t").getField(f).cast("array<string>").alias(f"f{i}") for i, f in enumerate(fields)]
    toks = F.col("t").getField("tok_no").cast("array<bigint>").alias("toks")
    sents = gathered(tokens, fields).select(col("text_id").cast("string").alias("text_id"), *(col(k).cast("long").alias(k) for k in keys[1:]), toks, *values)

    def keys_of(t: pa.Table, block: int) -> pa.Table:
        coded = t["text_id"].combine_chunks().dictionary_encode()
        code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(np.diff(code, prepend=-2))
        ends = np.append(begins[1:], len(code))
        row = {"block": block, "n": len(code), "sents": narrow(t["sent_no"].to_numpy()), "texts": t["text_id"].take(pa.array(begins)).to_pylist(), "ends": packed(ends), "paras": narrow(t["para_no"].to_numpy())}
        return pa.Table.from_pylist([row], pa.schema(LIST))

    def lists(t: pa.Table, block: int) -> Iterator[pa.Table]:
        toks = t["toks"].combine_chunks()
        nr, tok = np.repeat(np.arange(len(t)), pc.list_value_length(toks).to_numpy(zero_copy_only=False)), toks.flatten().to_numpy()
        for i, f in enumerate(fields):
            coded = t[f"f{i}"].combine_chunks().flatten().dictionary_encode()
            code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            order = order[np.searchsorted(code[order], 0) :]
            if not len(order):
                continue
            begins = np.flatnonzero(np.diff(code[order], prepend=-1))
            # a token's number falls where a sentence begins, so these differences are of the number added to all before
            added = np.cumsum(tok[order])
            added -= np.repeat(added[begins] - tok[order[begins]], np.diff(begins, append=len(order)))
            n = np.diff(begins, append=len(order))
            value = coded.dictionary.take(pa.array(code[order[begins]]))
            columns = [pa.array([f] * len(begins), pa.string()), value, pa.array(np.full(len(begins), block, np.int64)), pa.array(n), packed_all(nr[order], begins), packed_all(added, begins)]
            columns += [pa.nulls(len(begins), kind) for _, kind in LIST[len(columns) :]]
            yield pa.table(columns, schema=pa.schema(LIST))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, names = TaskContext.get().partitionId() << 32, [x.split(" ")[0] for x in MADE.split(", ")]
        for k, t in enumerate(blocks(batches)):
            for made in (keys_of(t, first + k), *lists(t, first + k)):
                yield from made.select(names).to_batches()

    made = sents.mapInArrow(index, MADE)
    # lists of a frequent value are in a file for each ``TOGETHER`` blocks of a task
    parted = made.withColumns({"part": F.when(F.col("field").isNotNull(), _part(F.col("value"))), "run": F.when(F.col("field").isNotNull(), (F.col("block").bitwiseAND((1 << 32) - 1) / TOGETHER).cast("int"))})
    parted.sortWithinPartitions("field", "part", "run", "value", "block").write.mode("errorifexists").partitionBy("field", "part", "run").parquet(f"{path}/lists")


def lexicon(spark: SparkSession, path: str, field: str) -> DataFrame:
    """value, freq: each value of a field; no list is unpacked."""
    return spark.read.schema(LISTS).parquet(f"{path}/lists").where(F.col("field") == field).groupBy("value").agg(F.sum("n").alias("freq"))


def _lists(spark: SparkSession, path: str, steps: Sequence[Step]) -> DataFrame:
    rows, out = spark.read.schema(LISTS).parquet(f"{path}/lists"), []
    for s, step in enumerate(steps):
        if not step.fields:
            raise BadData("a step without a field")
        for f, (field, wanted) in enumerate(step.fields.items()):
            own = rows.where(F.col("field") == field)
            if isinstance(wanted, Where):
                own = own.where(wanted.condition)
            else:
                values = [wanted] if isinstance(wanted, str) else list(dict.fromkeys(wanted))
                one = [(F.col("part") == _part(F.lit(v))) & (F.col("value") == v) for v in values]
                own = own.where(reduce(lambda a, b: a | b, one, F.lit(False)))
            out.append(own.select("block", F.lit(s).alias("step"), F.lit(f).alias("nr"), "sents", "toks", *KEYS_OF))
    return reduce(DataFrame.union, out)


def find(spark: SparkSession, path: str, steps: Sequence[Step]) -> DataFrame:
    """Per place where the steps' tokens stand: keys of the sentence, first and last token. Places with equal ends are one."""
    wanted = [len(s.fields) for s in steps]
    gaps = [s.gap for s in steps]

    def meet(t: pa.Table) -> pa.Table:
        step, nr = (t.column(c).to_numpy() for c in ("step", "nr"))
        sents, toks = t.column("sents").to_pylist(), t.column("toks").to_pylist()
        places: list[np.ndarray] = []
        for s, n in enumerate(wanted):
            at: np.ndarray | None = None
            for f in range(n):
                rows = np.flatnonzero((step == s) & (nr == f)).tolist()
                # sentence and token in one number: the next token is one more, and another sentence is far
                own = np.unique(np.concatenate([np.zeros(0, np.int64), *((unpacked(sents[r]) << 32) + np.diff(unpacked(toks[r]), prepend=0) for r in rows)]))
                at = own if at is None else np.intersect1d(at, own, assume_unique=True)
            places.append(at)
        first = last = places[0]
        for at, (lo, hi) in zip(places[1:], gaps[1:], strict=True):
            begin, end = np.searchsorted(at, last + 1 + lo), np.searchsorted(at, last + 1 + hi, "right")
            n = np.maximum(end - begin, 0)
            last = at[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
            first = np.repeat(first, n)
            order = np.lexsort((last, first))
            first, last = first[order], last[order]
            new = (np.diff(first, prepend=-1) != 0) | (np.diff(last, prepend=-1) != 0)
            first, last = first[new], last[new]
        own, at = t.slice(int(np.flatnonzero(step < 0)[0]), 1).to_pylist()[0], first >> 32
        text = pa.array(own["texts"], pa.string()).take(pa.array(np.searchsorted(unpacked(own["ends"]), at, "right")))
        columns = [text, pa.array(widened(own["paras"])[at]), pa.array(widened(own["sents"])[at]), pa.array(first & 0xFFFFFFFF), pa.array(last & 0xFFFFFFFF)]
        return pa.table(columns, names=[*KEYS["sentence"], "first", "last"])

    # lists are small beside what they unpack to, so their tasks aren't to be made fewer by size
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = spark.read.schema(LISTS).parquet(f"{path}/lists").where("field IS NULL").select("block", F.lit(-1).alias("step"), F.lit(0).alias("nr"), "sents", "toks", *KEYS_OF)
    return _lists(spark, path, steps).union(keys).repartition(parts, "block").groupBy("block").applyInArrow(meet, "text_id string, para_no bigint, sent_no bigint, first bigint, last bigint")
