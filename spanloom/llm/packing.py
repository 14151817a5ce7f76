"""Packing documents into token sequences: first-fit decreasing within randomised groups.

Documents are cut into full sequences and a remainder. Full pieces need no search. Each task tokenises its rows; what is
shuffled is a few numbers per piece, never ids. Documents are dealt to groups at random (a seeded draw made in the scan,
so that equal or repeated ids can't gather in one group), each of about ``group_docs`` documents. In a group, the
remainders are placed by first-fit decreasing; a tournament tree of the free room of each bin finds the first bin that
fits in logarithmic time.

Defined results: null and empty texts are a document of the end id alone; repeated rows are documents of their own;
ties in length go by id, then by order in the group; an empty table gives an empty table; other columns are ignored.
A piece's ids never leave their task, so memory is one Arrow batch plus the memo of words, of at most twice ``MEMO``
entries.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw

MEMO = 600_000
PART = 1 << 21  #: characters that are split at a time
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Tokens:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    The vocabulary's pre-tokeniser never joins across white space, so a text's ids are those of its white-space
    separated stretches, and each distinct stretch is tokenised once. Splitting at the space, tab and line ends only
    leaves all other white space to the tokeniser. Stretches of letters, with or without one mark behind them, share
    the ids of the lower-case word; new words are tokenised many at once and told apart by the ids that end a word.
    The memo has two generations of ``MEMO`` stretches: what was not met during one is forgotten.
    """

    MARKS = ".,;:!?"

    def __init__(self, path: str, memo: int | None = None):
        from tokenizers import Tokenizer

        self.most = memo or MEMO
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.marks = dict(zip(self.MARKS, self._each(list(self.MARKS)), strict=True))
        self.memo: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _each(self, stretches: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """words: letters only."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cut = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(cut) != len(words) + 1 or cut[-1] != len(ids):
            return self._each(words)
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def fill(self, stretches: set[str]) -> None:
        """Afterwards the memo has all of these."""
        if len(self.memo) > self.most:
            self.memo, self.old = {"": b""}, self.memo
        memo, old = self.memo, self.old
        rest = stretches.difference(memo)
        self._carry(rest)
        plain, marked, other = [], [], []
        for x in rest.difference(memo) if old else rest:
            if x.isalpha():
                (other if "\u0130" in x else plain).append(x)
            elif x[-1] in self.MARKS and x[:-1].isalpha() and "\u0130" not in x:
                marked.append(x)
            else:
                other.append(x)
        lower = [x.lower() if x.isascii() else x for x in plain]
        words = [x[:-1].lower() if x.isascii() else x[:-1] for x in marked]
        new = {*lower, *words}.difference(memo)
        self._carry(new)
        new = list(new.difference(memo) if old else new)
        memo.update(zip(new, self._words(new), strict=True))
        memo.update(zip(plain, map(memo.__getitem__, lower), strict=True))
        memo.update((x, memo[w] + self.marks[x[-1]]) for x, w in zip(marked, words, strict=True))
        if other:
            memo.update(zip(other, self._each(other), strict=True))

    def _carry(self, stretches: set[str]) -> None:
        """What the older generation has of these is met again."""
        if self.old:
            self.memo.update((x, self.old[x]) for x in stretches if x in self.old)

    def __call__(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text. Texts go in groups, a very long one in parts, so that what is split at a time stays small."""
        group: list[str] = []
        size = 0
        for text in texts:
            if len(text) > PART:
                yield from self._group(group)
                group, size = [], 0
                yield b"".join(x for part in self._parts(text) for x in self._group([part]))
                continue
            group.append(text)
            size += len(text)
            if size > PART:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        """Only distinct stretches become strings here; a text's ids are gathered from theirs."""
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([x.replace("\n", " ").replace("\t", " ").replace("\r", " ") for x in texts], pa.string()), " ")
        stretches = lists.flatten().dictionary_encode()
        distinct, at = stretches.dictionary.to_numpy(zero_copy_only=False).tolist(), stretches.indices.to_numpy()
        self.fill(set(distinct))
        found = list(map(self.memo.__getitem__, distinct))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        size = size[at]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(first[at] - end[:-1], size) + np.arange(end[-1])]
        bounds = end[lists.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    @staticmethod
    def _parts(text: str) -> Iterator[str]:
        """Cut at blanks, where no id reaches across."""
        at = 0
        while at < len(text):
            cut = text.find(" ", at + PART)
            cut = len(text) if cut < 0 else cut
            yield text[at:cut]
            at = cut


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, groups: int = 1, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", memo: int | None = None) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, start, length, ids_crc32, doc_tokens, and a random group."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), (F.rand(seed) * groups).cast("int").alias("grp"))
    end = np.array([end_id], "<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer_path, memo)
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            texts = (x.as_py() or "" for x in b.column(1))
            for doc, ids, group in zip(b.column(0).to_pylist(), tokens(texts), b.column(2).to_pylist(), strict=True):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, capacity):
                    piece = ids[4 * at : 4 * (at + capacity)]
                    for column, value in zip(out, (doc, at, len(piece) // 4, zlib.crc32(piece), n, group), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5], pa.int32())], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp"])

    return rows.mapInArrow(tw.tidy(scan), f"{PIECES}, grp int")


class Tournament:
    """Bins' free room under a tree of maxima; ``place`` finds the first bin with enough of it."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """The bin, and its free room before."""
        room, node = self.room, 1
        while node < self.size:
            node *= 2
            node += room[node] < need
        free = room[node]
        room[node] = free - need
        bin_ = node - self.size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin_, free


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """By item: bin and offset in it. Items of equal length keep their order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = Tournament(max(1, len(lengths)), capacity)
    for i in np.argsort(-lengths, kind="stable"):
        bins[i], free = tree.place(int(lengths[i]))
        offsets[i] = capacity - free
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group_docs: int = 4096, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", memo: int | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A smaller ``memo`` than ``MEMO`` takes less memory and more time."""
    groups = max(1, -(-docs.count() // group_docs))
    pieces = cut(docs, tokenizer_path, capacity, end_id, groups, seed, id_col, text_col, memo)

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("doc_id", "start", "length", "ids_crc32")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        sequence = (group["grp"].to_numpy().astype(np.int64) << 32) + bins
        return group.drop_columns("grp").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    return pieces.groupBy("grp").applyInArrow(place, f"{PIECES}, sequence_id bigint, offset bigint")
