import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import index
from spanloom.operators.index import Step, Where
from spanloom.operators.relation import BadData
from spanloom.sources import corpus as C

WORDS = ["a", "b", "c", "dd", "é", "the"]


@pytest.fixture(scope="module")
def tokens(spark):
    r = random.Random(5)
    rows = []
    for text in range(9):
        for sent in range(1, 12):
            for tok in range(1, r.randrange(2, 14)):
                w = r.choice(WORDS)
                rows.append((f"t{text}", 1, sent, tok, w, "v" if w in "ab" else None if w == "é" else "n"))
    rows += [("long", 1, 1, i, WORDS[i % 6], "n") for i in range(1, 70_000)]
    return rows, spark.createDataFrame(rows, "text_id string, para_no long, sent_no long, tok_no long, word string, pos string")


@pytest.fixture(scope="module")
def path(spark, tokens, tmp_path_factory):
    before, index.BLOCK = index.BLOCK, 200
    out = f"file://{tmp_path_factory.mktemp('index')}/i"
    index.build(tokens[1], out, ["word", "pos"])
    index.BLOCK = before
    return out


def brute(rows, steps):
    """steps: (test of word and pos, gap)"""
    sents = {}
    for t, p, s, n, w, pos in rows:
        sents.setdefault((t, p, s), []).append((w, pos))
    out = set()
    for key, toks in sents.items():
        ends = {(i, i) for i, x in enumerate(toks) if steps[0][0](*x)}
        for test, (lo, hi) in steps[1:]:
            ends = {(a, j) for a, z in ends for j in range(z + 1 + lo, min(len(toks), z + 2 + hi)) if test(*toks[j])}
        out |= {(*key, a + 1, z + 1) for a, z in ends}
    return sorted(out)


CASES = {
    "one": ([Step({"word": "é"})], [(lambda w, p: w == "é", None)]),
    "next": ([Step({"word": "a"}), Step({"word": "b"})], [(lambda w, p: w == "a", None), (lambda w, p: w == "b", (0, 0))]),
    "gap": ([Step({"word": "a"}), Step({"word": ["b", "é"]}, (1, 3)), Step({"pos": "n"}, (0, 1))], [(lambda w, p: w == "a", None), (lambda w, p: w in ("b", "é"), (1, 3)), (lambda w, p: p == "n", (0, 1))]),
    "fields": ([Step({"word": "the", "pos": "n"}), Step({"pos": "v", "word": Where("value RLIKE '^[bc]$'")})], [(lambda w, p: w == "the" and p == "n", None), (lambda w, p: p == "v" and w == "b", (0, 0))]),
    "itself": ([Step({"word": "dd"}), Step({"word": "dd"}, (0, 20))], [(lambda w, p: w == "dd", None), (lambda w, p: w == "dd", (0, 20))]),
    "nothing": ([Step({"word": "a"}), Step({"word": "zzz"})], [(lambda w, p: False, None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_sequences_equal_brute_force(spark, tokens, path, name):
    steps, plain = CASES[name]
    assert sorted(map(tuple, index.find(spark, path, steps).collect())) == brute(tokens[0], plain)


def test_lexicon(spark, tokens, path):
    want = {}
    for r in tokens[0]:
        want[r[4]] = want.get(r[4], 0) + 1
    assert dict(map(tuple, index.lexicon(spark, path, "word").collect())) == want


def test_lookup_reads_the_files_of_its_values(spark, path):
    whole = len(spark.read.parquet(f"{path}/lists").inputFiles())
    rows = index._lists(spark, path, [Step({"word": "a"})])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(field" in plan and "PushedFilters: [IsNotNull(value), EqualTo(value,a)]" in plan
    assert rows.select(index.F.input_file_name()).distinct().count() < whole / 3


def test_packing():
    for x in ([], [0], [5, 6, 300], [1, 70_000, 1 << 40], list(range(1000))):
        assert index.unpacked(index.packed(np.array(x, np.int64))).tolist() == x


def test_errors(spark, tokens, path, tmp_path):
    with pytest.raises(BadData):
        index.build(tokens[1], f"file://{tmp_path}/x", ["lemma"])
    with pytest.raises(BadData):
        index.find(spark, path, [Step({})])
    with pytest.raises(Exception, match="(?i)exists"):
        index.build(tokens[1].limit(5), path, ["word"])


def test_empty(spark, tokens, tmp_path):
    index.build(tokens[1].limit(0), f"file://{tmp_path}/e", ["word"])
    assert index.lexicon(spark, f"file://{tmp_path}/e", "word").count() == 0
    assert index.find(spark, f"file://{tmp_path}/e", [Step({"word": "a"}), Step({"word": "b"})]).count() == 0


def test_lists_are_packed_together_as_one_by_one():
    rng = np.random.default_rng(3)
    parts = [np.sort(rng.integers(0, most, n)) for n, most in [(1, 10), (5, 300), (3, 1 << 17), (4, 1 << 40), (2, 255), (1, 1 << 33), (300, 1000)]]
    begins = np.cumsum([0, *map(len, parts)])[:-1]
    assert [x.as_py() for x in index.packed_all(np.concatenate(parts), begins)] == [index.packed(p) for p in parts]


def test_an_index_is_made_without_a_row_for_each_token(spark, tmp_path, monkeypatch):
    """build: a corpus that has arrays is never read by its tokens; lists of one value are in several files."""
    corpus = C.from_texts(spark.createDataFrame([(i, "a b a. B a\nc a b") for i in range(40)], "id long, text string"), "id", "text")
    monkeypatch.setattr(index, "BLOCK", 20)
    monkeypatch.setattr(index, "TOGETHER", 1)
    index.build(corpus._replace(tokens=corpus.tokens.withColumn("word", F.raise_error(F.lit("tokens were read")).cast("string"))).with_arrays(corpus.arrays), f"{tmp_path}/i", ["word"])
    assert {r["value"]: r["freq"] for r in index.lexicon(spark, f"{tmp_path}/i", "word").collect()} == {"a": 160, "b": 80, "B": 40, "c": 40}
    found = index.find(spark, f"{tmp_path}/i", [index.Step({"word": "a"}), index.Step({"word": "b"}), index.Step({"word": "a"}, (0, 1))])
    assert sorted({(r["para_no"], r["sent_no"], r["first"], r["last"]) for r in found.collect()}) == [(1, 1, 1, 3)]


def test_an_index_is_written_once_and_not_shuffled(spark, tmp_path, monkeypatch):
    """build: what is written is the index only, where sentences are read; blocks end within texts and batches, texts may be null or without words, numbers may be large."""
    plans, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *a, f=frame.sortWithinPartitions, **k: plans.append(self._jdf.queryExecution().executedPlan().toString()) or f(self, *a, **k))
    monkeypatch.setattr(index, "BLOCK", 20)
    docs = [(i, "\n" * 300 + "a b a. B a\nc a b" + ". x" * 300) for i in range(12)] + [(None, "a b. a b"), (90, None), (91, ""), (92, "a b a")]
    corpus = C.from_texts(spark.createDataFrame(docs, "id long, text string").repartition(3), "id", "text")
    index.build(corpus, f"{tmp_path}/i", ["word"])
    assert len(plans) == 1 and "Exchange hash" not in plans[0] and [p.name for p in tmp_path.joinpath("i").iterdir()] == ["lists"]
    rows = corpus.tokens.selectExpr("coalesce(cast(text_id AS string), '-')", "para_no", "sent_no", "tok_no", "word", "''").collect()
    got = index.find(spark, f"{tmp_path}/i", [Step({"word": "a"}), Step({"word": "b"})]).selectExpr("coalesce(text_id, '-')", "para_no", "sent_no", "first", "last")
    assert sorted(map(tuple, got.collect())) == brute(map(tuple, rows), [(lambda w, p: w == "a", None), (lambda w, p: w == "b", (0, 0))])
    assert spark.read.schema(index.LISTS).parquet(f"{tmp_path}/i/lists").where("field IS NULL").agg(F.sum("n")).first()[0] == corpus.sentences.count()
