import hashlib
import random
import re

import numpy as np
import pytest
from tests.llm import cases

from spanloom.llm import repeats, suffix_arrays, suffix_trees

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_words(rows, n):
    least = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - n + 1):
            if i is not None:
                least[tuple(w[s : s + n])] = min(i, least.get(tuple(w[s : s + n]), i))
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for s in range(len(w) - n + 1):
            if i is not None and least[tuple(w[s : s + n])] < i:
                gone |= set(range(s, s + n))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, n):
    count = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for s in range(len(b) - n + 1):
            count[b[s : s + n]] = count.get(b[s : s + n], 0) + 1
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - n + 1):
            if count[b[s : s + n]] > 1:
                gone[s : s + n] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])).hexdigest()))
    return sorted(out, key=str)


def tangled(seed, n):
    """Texts that share stretches, some with small edits, in a small vocabulary."""
    r = random.Random(seed)
    pool = [cases.prose(seed * 100 + k, 90, "a b c dd".split()) for k in range(5)] + ["ab " * 120]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(1, 5)):
            w = r.choice(pool).split()
            a = r.randrange(len(w))
            w = w[a : a + r.randrange(20, 110)]
            if w and r.random() < 0.4:
                w[r.randrange(len(w))] = "edit%d" % r.randrange(99)
            parts.append(" ".join(w))
        rows.append((i * 7 % n, (" " if r.random() < 0.7 else "\n\t").join(parts)))
    return rows + rows[:3]


@pytest.mark.parametrize("rows", [cases.awkward(), tangled(1, 60), tangled(2, 60)], ids=["awkward", "a", "b"])
@pytest.mark.parametrize("group", [50_000, 3])
def test_words(spark, monkeypatch, rows, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    got = suffix_trees.digest(cases.documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == brute_words(rows, 50)


@pytest.mark.parametrize("rows", [cases.awkward(), tangled(1, 60), tangled(2, 60)], ids=["awkward", "a", "b"])
@pytest.mark.parametrize("group", [50_000, 3])
def test_bytes(spark, monkeypatch, rows, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    got = suffix_arrays.digest(cases.documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == brute_bytes(rows, 400)


def letters(seed, n):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def test_quote_of_a_hot_body(spark, monkeypatch):
    """The quote's surroundings are unique, those of the body are all repeated."""
    monkeypatch.setattr(repeats, "GROUP", 3)
    body = letters(0, 3000)
    rows = [(i, letters(i + 1, 500) + body) for i in range(6)] + [(6, letters(90, 700) + "#" + body[1200:1650] + "#" + letters(91, 700))]
    got = sorted(map(tuple, suffix_arrays.digest(cases.documents(spark, rows)).collect()), key=str)
    assert got == brute_bytes(rows, 400) and got[-1][2] == 450


def test_two_hot_anchors_in_a_window(spark, monkeypatch):
    """Texts share stretches shorter than a window that hold two anchors: nothing is repeated."""
    monkeypatch.setattr(repeats, "GROUP", 3)
    rows = [(100 * k + i, letters(1000 * k + i, 500) + shared + letters(1000 * k + 500 + i, 500)) for k in range(4) for shared in [letters(-1 - k, 390)] for i in range(30)]
    got = sorted(map(tuple, suffix_arrays.digest(cases.documents(spark, rows)).collect()), key=str)
    assert got == brute_bytes(rows, 400) and not any(r[2] for r in got)


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_short_texts_and_copies(spark, monkeypatch, kind):
    """Most texts are shorter than a window, and one text is a third of the others: neither gathers in a join."""
    monkeypatch.setattr(repeats, "HELD", 3)
    copied = cases.prose(4, 110)
    rows = [(i, f"short {i}") for i in range(200)] + [(300 + i, copied if i % 3 == 0 else cases.prose(500 + i, 100)) for i in range(30)] + [(None, copied), (None, "short")]
    digest, brute = (suffix_trees.digest, lambda r: brute_words(r, 50)) if kind == "words" else (suffix_arrays.digest, lambda r: brute_bytes(r, 400))
    assert sorted(map(tuple, digest(cases.documents(spark, rows)).collect()), key=str) == brute(rows)


def test_orders_agree():
    """Merging sorted shards gives what sorting all suffixes gives."""
    rng = np.random.default_rng(5)
    for width in (1, 7, 8, 30):
        for shards in (1, 4, 300):
            group, ahead, shard = rng.integers(0, 5, 300), rng.integers(0, 2, (300, width)).astype(np.uint64), rng.integers(0, shards, 300)
            place, same = np.zeros(300, np.int64), np.zeros(300, np.int64)
            for k in range(shards):
                mine = np.flatnonzero(shard == k)
                if len(mine):
                    order, shared = suffix_arrays.sort_shard(group[mine], ahead[mine])
                    place[mine[order]], same[mine[order]] = np.arange(len(mine)), shared
            want_order, want = suffix_trees.suffix_tree(group, ahead)
            order, shared = suffix_arrays.interleave(group, ahead, shard, place, same)
            assert (ahead[order] == ahead[want_order]).all() and (group[order] == group[want_order]).all() and (shared == want).all()


def test_empty(spark):
    docs = cases.documents(spark, [])
    assert suffix_trees.digest(docs).count() == 0 and suffix_arrays.digest(docs).count() == 0
