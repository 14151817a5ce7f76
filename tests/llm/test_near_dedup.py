import random

import pytest
from tests.llm import cases

from spanloom.llm import near_dedup
from spanloom.llm.components import components
from spanloom.session import Scratch

CUT = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def shingles(t):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").translate(CUT).split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    comp = {i: i for i, _ in rows if i is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            if i is not None and j is not None and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for (i, _), s in zip(rows, sets)), key=str)


def variants(seed, n, base, edits):
    r = random.Random(seed)
    out = []
    for k in range(n):
        w = base.split()
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"edit{k}x{r.randrange(9)}"
        out.append(" ".join(w))
    return out


def framed(n):
    """A family with one frame and a part of their own each: below the threshold, but for a few."""
    frame, out = cases.prose(40, 80).split(), []
    for k in range(n):
        own = cases.prose(1000 + k - (k % 9 == 0), 22).split()
        out.append(" ".join(frame[:40] + own + frame[40:]))
    return out


@pytest.mark.parametrize("kind, path", [("awkward", "tasks"), ("hot", "tasks"), ("short", "tasks"), ("chains", "rounds"), ("frames", "rounds"), ("awkward", "given up"), ("frames", "given up")])
def test_equals_brute_force(spark, monkeypatch, kind, path):
    if path == "rounds":
        monkeypatch.setattr(near_dedup, "CLUSTER", 1500)
        monkeypatch.setattr(near_dedup, "MEMBERS", 7)
    if path == "given up":
        monkeypatch.setattr(near_dedup, "WORK", 60)
    rows = cases.awkward()
    if kind == "chains":
        rows = [(i, t) for i, t in enumerate(x for s in range(12) for x in variants(s, 12, cases.prose(s, 60), 6))]
    if kind == "hot":  # one large group whose pairs lie around the threshold, most of them below
        rows = list(enumerate(variants(3, 220, cases.prose(3, 90), 5) + [cases.prose(3, 90)] * 30))
    if kind == "frames":
        rows = list(enumerate(framed(150)))
    if kind == "short":  # few shingles each, chained one by one
        w = cases.prose(9, 130).split()
        rows = [(i, " ".join(w[i : i + 30])) for i in range(100)] + [(100 + i, " ".join(w[: 1 + i % 6])) for i in range(40)]
    random.Random(1).shuffle(rows)
    got = sorted(map(tuple, near_dedup.digest(cases.documents(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_keep_first_and_empty(spark):
    docs = cases.documents(spark, cases.awkward())
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in brute(cases.awkward()) if r[3])
    assert near_dedup.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("held, few", [(500, 100), (3, 100), (3, 0)], ids=["plain", "broadcast", "salted"])
def test_components(spark, monkeypatch, held, few):
    monkeypatch.setattr("spanloom.llm.components.HELD", held)
    monkeypatch.setattr("spanloom.llm.skew.FEW", few)
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(60)] + [(300, 300 + i) for i in range(1, 50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    want = sorted((x, root(x)) for x in list(parent))
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"))
    assert sorted(map(tuple, got.collect())) == want
