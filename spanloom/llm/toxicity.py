"""Toxicity by a misspelling-tolerant lexicon with context windows.

The lexicon is learned from labelled rows: words that toxic documents hold far more often than others. It is kept as a
trie, and the Levenshtein automata of its terms (no edit below four letters, one below ten, two from there; one in terms
of four letters only where no clean learning document has a word that near) are intersected with it; the product is
determinised lazily, so a word costs one table step a letter and most words leave the automaton after a few. What is
looked up are runs of letters and, in stretches without a space where none of these is a term, the whole stretch with the
digits and marks inside it, so that each of these in place of a letter is one edit. Each hit is looked at in a window of
words around it: hits inside quotation marks or next to reporting words count apart from direct ones, and hits near a
second person apart from others. A logistic model over these counts gives the score.

Learning takes a bounded sample of labelled rows (``FIT_ROWS``, a documented bound). Half of it gives the lexicon, the
other half the logistic weights, so that terms are weighed on documents they were not found in. All words of the sample
that meet ``MIN_DOCS`` and ``MIN_ODDS`` are terms. Scoring takes whole texts and is a single scan without a shuffle.

Defined results: null and empty texts are scored as texts without hits; a table without labelled rows of both classes
gives a model without terms and the score of the base rate; repeated rows repeat their result; an empty table gives an
empty table; other columns are ignored (``score``) or passed on (``drop_toxic``). A very long text is one string and its
words in the task that scores it; texts are taken one by one.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textwork as tw
from spanloom.session import Scratch

FIT_ROWS = 20_000
MIN_DOCS, MIN_ODDS = 5, 3.0
WINDOW = 6
CLEAN = 500_000  #: words known to be without hit, in each of two generations
STATES = 100_000
WORD = re.compile(r"[^\W\d_]+")
#: From the first letter or digit of a stretch without a space to its last.
SPELLED = re.compile(r"[^\W_](?:\S*[^\W_])?")
#: Words that introduce a quotation, and second persons, in the four languages of the tables.
REPORTING = frozenset("said says say wrote writes called calls quote quoted reported dit disait écrit sagte sagt schrieb dijo dice escribió".split())
SECOND_PERSON = frozenset("you your yours u ur tu vous ton ta toi du dich dir euch ihr tú usted ustedes vosotros".split())
QUOTES = {"“": "”", "«": "»", "„": "“", '"': '"', "‘": "’"}
MARKS = re.compile("[" + "".join(sorted({*QUOTES, *QUOTES.values()})) + "]")


def budget(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


def spelled(chunk: str) -> re.Match | None:
    """What a stretch without a space is from its first to its last letter or digit, if it has letters and other characters."""
    whole = SPELLED.search(chunk)
    return whole if whole and not whole[0].isalpha() and WORD.search(whole[0]) else None


class Automaton:
    """The trie of the terms crossed with their Levenshtein automata, determinised as words pass through."""

    def __init__(self, terms: list[str], budgets: list[int] | None = None):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most = [0]  #: the largest budget below a node
        self.budgets = budgets if budgets is not None else [budget(t) for t in terms]
        for i, t in enumerate(terms):
            node = 0
            self.most[0] = max(self.most[0], self.budgets[i])
            for ch in t:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.children[node][ch]
                self.most[node] = max(self.most[node], self.budgets[i])
            self.term[node] = i
        self._reset()

    def _reset(self) -> None:
        self.sets: list[bytes] = []  #: by state, 4 * trie node + fewest edits, as sorted 32-bit integers
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.known: dict[bytes, int] = {}
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """nodes: fewest edits by trie node. Letters that the word lacks are free steps that cost an edit."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            if nodes[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and nodes.get(child, 99) > edits + 1:
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        if not nodes:
            return -1
        key = array("i", sorted(4 * n + e for n, e in nodes.items())).tobytes()
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e in nodes.items() if self.term[n] >= 0 and e <= self.budgets[self.term[n]]]
            self.accepts.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.known[key]

    def _step(self, state: int, ch: str) -> int:
        after: dict[int, int] = {}
        for node, edits in (divmod(x, 4) for x in array("i", self.sets[state])):
            if edits + 1 <= self.most[node]:
                after[node] = min(after.get(node, 99), edits + 1)  # a letter too many
            for letter, child in self.children[node].items():
                cost = edits + (letter != ch)
                if cost <= self.most[child]:
                    after[child] = min(after.get(child, 99), cost)
        self.steps[state][ch] = found = self._state(after)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """The term with the fewest edits (of equals, the first), and the edits."""
        if len(self.sets) > STATES:
            self._reset()
        state = self.start
        steps = self.steps
        for ch in word:
            after = steps[state].get(ch)
            state = self._step(state, ch) if after is None else after
            if state < 0:
                return None
        return self.accepts[state]


class Model(NamedTuple):
    terms: list[str]
    weights: list[float]
    betas: list[float]
    budgets: list[int] | None = None  #: edits by term


class Reader:
    """Finds the hits of texts and sums them by context. One per task."""

    def __init__(self, terms: list[str], weights: list[float], budgets: list[int] | None = None):
        self.automaton, self.weights = Automaton(terms, budgets), weights
        self.clean: set[str] = set()
        self.older: set[str] = set()

    def hits(self, chunk: str) -> list[tuple[int, tuple[int, int]]]:
        """Where in a stretch without a space there are terms, and the terms with their edits."""
        found = [(m.start(), hit) for m in WORD.finditer(chunk) if (hit := self.automaton.match(m[0]))]
        if not found and (whole := spelled(chunk)) and (hit := self.automaton.match(whole[0])):
            found = [(whole.start(), hit)]
        return found

    def features(self, text: str | None) -> list[float]:
        """By context (direct, to a second person, quoted): weight of exact hits; weight of misspelled hits in all."""
        out = [0.0] * 5
        if not text or not self.weights:
            return out
        lower = text.lower()
        chunks = set(lower.split())
        chunks -= self.clean
        dirty: dict[str, list[tuple[int, tuple[int, int]]]] = {}
        match, clean, older = self.automaton.match, self.clean, self.older
        for chunk in chunks:
            if chunk in older:
                clean.add(chunk)
            elif chunk.isalpha():
                hit = match(chunk)
                if hit:
                    dirty[chunk] = [(0, hit)]
                else:
                    clean.add(chunk)
            elif found := self.hits(chunk):
                dirty[chunk] = found
            else:
                clean.add(chunk)
        if len(clean) > CLEAN:
            self.clean, self.older = set(), clean
        if not dirty:
            return out
        found = [(m.start() + at, hit) for m in re.finditer(r"\S+", lower) for at, hit in dirty.get(m[0], ())]
        runs = [(m.start(), m[0]) for m in WORD.finditer(lower)]
        starts, words = [x for x, _ in runs], [w for _, w in runs]
        quoted = self._quoted(lower)
        opens = [a for a, _ in quoted]
        for at, (term, edits) in found:
            i = bisect_left(starts, at)
            weight = self.weights[term]
            q = bisect_left(opens, at) - 1
            if edits:
                out[3] += weight
            elif (q >= 0 and at < quoted[q][1]) or not REPORTING.isdisjoint(words[max(0, i - WINDOW) : i]):
                out[2] += weight
            elif not SECOND_PERSON.isdisjoint(words[max(0, i - WINDOW) : i + WINDOW + 1]):
                out[1] += weight
            else:
                out[0] += weight
            out[4] = max(out[4], weight if not edits else 0.0)
        return out

    @staticmethod
    def _quoted(text: str) -> list[tuple[int, int]]:
        """Stretches between quotation marks that close within their line, in order; of those inside each other, the outer."""
        out = []
        for line in re.finditer(r"[^\n]+", text):
            marks = [(m.start(), m[0]) for m in MARKS.finditer(text, line.start(), line.end())]
            places: dict[str, list[int]] = {}
            for at, mark in marks:
                places.setdefault(mark, []).append(at)
            end = -1
            for at, mark in marks:
                close = places.get(QUOTES.get(mark, ""), [])
                k = bisect_right(close, at)
                if at > end and k < len(close):
                    end = close[k]
                    out.append((at, end))
        return out


def squash(features: np.ndarray) -> np.ndarray:
    x = np.log1p(features)
    return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Newton steps with a ridge on all but the first weight."""
    beta = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull * len(y) / 100 + 1e-9)
        step = np.linalg.solve(h, x.T @ (y - p) - pull * len(y) / 100 * beta)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """labels: those that may be learned from."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model([], [], [math.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5)) if sizes else -4.0] + [0.0] * 5)
    share = {y: min(1.0, fit_rows / 2 / n) for y, n in sizes.items()}
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    drawn = known.where(place < F.when(F.col("y") == 1, share[1]).otherwise(share[0]) * 1_000_000).orderBy(F.xxhash64("id")).limit(2 * fit_rows)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(drawn), "id")
    texts = texts.withColumn("half", F.pmod(F.crc32(F.col("id").cast("string")) / 5, F.lit(2)).cast("int")).select("text", "y", "half")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter[tuple[str, int]]()
        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                lower = t.as_py().lower()
                wholes = map(spelled, {c for c in lower.split() if not c.isalpha()})
                seen.update((w, y) for w in {"", *WORD.findall(lower), *(m[0] for m in wholes if m)})
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in seen], pa.string()), pa.array([n * y for (_, y), n in seen.items()], pa.int64()), pa.array([n * (1 - y) for (_, y), n in seen.items()], pa.int64())], ["word", "bad", "good"])

    words = texts.where("half = 0").drop("half").mapInArrow(tw.tidy(count), "word string, bad bigint, good bigint").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    words = Scratch(docs.sparkSession, "toxicity").write(words)
    total = words.where("word = ''").first()
    if total is None:
        return Model([], [], [-4.0] + [0.0] * 5)
    odds = F.log((F.col("bad") + 0.5) / (total["bad"] + 1.0)) - F.log((F.col("good") + 0.5) / (total["good"] + 1.0))
    # at the class sizes of the whole, so that a sample with more of one class weighs words alike
    picked = words.where((F.length("word") >= 3) & F.rlike("word", F.lit(r"^\p{L}+$"))).withColumn("odds", odds).where((F.col("bad") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS))
    rows = picked.orderBy((F.col("odds") * F.log1p("bad")).desc(), "word").collect()  # words of the bounded sample
    terms, weights = [r["word"] for r in rows], [float(r["odds"]) for r in rows]
    budgets = _budgets(words, terms)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms, weights, budgets)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([reader.features(t.as_py()) for t in b.column(0)], pa.list_(pa.float64()))], ["y", "x"])

    half = texts.where("half = 1").select("text", "y").mapInArrow(tw.tidy(read), "y int, x array<double>").toPandas()
    if half["y"].nunique() < 2:
        return Model(terms, weights, [-2.0, 1.0, 1.0, 0.2, 0.5, 0.5], budgets)
    # undo the sampling of the classes in the intercept
    betas = logistic(squash(np.array(half["x"].tolist())), half["y"].to_numpy(float))
    betas[0] -= math.log(share[1] / share[0])
    return Model(terms, weights, betas.tolist(), budgets)


def _budgets(words: DataFrame, terms: list[str]) -> list[int]:
    """Edits by term. Terms of four letters get one where no clean document has a word that is one edit away."""
    found = [budget(t) for t in terms]
    four = [i for i, t in enumerate(terms) if len(t) == 4]
    if not four:
        return found

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # each term has an automaton of its own, as the nearest term alone would hide others
        tries = [(i, Automaton([terms[i]], [1])) for i in four]
        for b in batches:
            hit = {i for w in b.column(0).to_pylist() if 3 <= len(w) <= 5 for i, a in tries if (m := a.match(w)) and m[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(hit), pa.int64())], ["i"])

    barred = {r["i"] for r in words.where("good > 0").select("word").mapInArrow(near, "i bigint").distinct().collect()}  # a number a term
    return [1 if len(t) == 4 and i not in barred else n for i, (t, n) in enumerate(zip(terms, found, strict=True))]


def _scores(column: pa.Array, reader: Reader, betas: list[float]) -> np.ndarray:
    x = squash(np.array([reader.features(t.as_py()) for t in column], float).reshape(-1, 5))
    return 1 / (1 + np.exp(-np.clip(x @ np.array(betas), -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``score``."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.terms, model.weights, model.budgets)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(b.column(1), reader, model.betas), pa.float64())], ["id", "score"])

    return rows.mapInArrow(tw.tidy(scan), f"id {kind}, score double").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    at = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.terms, model.weights, model.budgets)
        for b in batches:
            yield b.filter(pa.array(_scores(b.column(at), reader, model.betas) < threshold))

    return docs.mapInArrow(tw.tidy(scan), docs.schema)


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the contract; rows whose crc32(doc_id) mod 5 is 0 are held out from all learning."""
    model = fit(docs.where(fold() != 0), labels.where(fold() != 0))
    held_out = F.coalesce(fold() == 0, F.lit(False))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
