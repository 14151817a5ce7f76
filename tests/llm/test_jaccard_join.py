import random

import numpy as np
import pytest
from tests.llm import cases
from tests.llm.test_near_dedup import CUT, framed, variants

from spanloom.llm import jaccard_join as jj


def shingles(t, words):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").translate(CUT).split(" ") if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, percent=85, words=4):
    sets = [shingles(t, words) for _, t in rows]
    comp = {i: i for i, _ in rows if i is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            if i is not None and j is not None and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)), key=str)


def near_bound():
    """Pairs whose sets are exactly at the bound, just above and just below: 185 shared of 200, ..."""
    rows = []
    for k, edits in enumerate([3, 4, 5, 6, 7, 8, 9, 10, 11, 12]):
        base = cases.prose(300 + k, 203).split()
        other = list(base)
        for e in range(edits):
            other[5 + e * 15] = f"other{e}"
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(other))]
    return rows


def tables(kind):
    if kind == "awkward":
        return cases.awkward() + [(20, cases.prose(8, 90)), (20, cases.prose(1, 120)), (21, cases.prose(8, 90)), (22, "one two three"), (23, "ONE two\tthree"), (24, "one two three four"), (25, "one two three four five")]
    if kind == "hot":  # copies that are a third of all, near copies, and a passage that all share
        shared = cases.prose(77, 30)
        return [(i, f"{shared} {t}") for i, t in enumerate(variants(1, 60, cases.prose(50, 100), 3) + [cases.prose(51, 100)] * 60 + [cases.prose(200 + i, 60) for i in range(60)])]
    if kind == "frames":
        return list(enumerate(framed(70)))
    if kind == "chains":
        r, rows, w = random.Random(4), [], cases.prose(9, 200).split()
        for i in range(60):
            rows.append((i * 7 % 61, " ".join(w)))
            w[r.randrange(200)] = f"new{i}"
            w[r.randrange(200)] = f"next{i}"
        return rows
    return near_bound()


@pytest.mark.parametrize("kind", ["awkward", "hot", "frames", "chains", "bound"])
@pytest.mark.parametrize("path", ["tasks", "rounds"])
def test_equals_brute_force(spark, monkeypatch, kind, path):
    if path == "rounds":
        monkeypatch.setattr(jj, "MEMBERS", 3)
        monkeypatch.setattr(jj, "HELD", 10)
    rows = tables(kind)
    got = sorted((tuple(r) for r in jj.classes(cases.documents(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_given_up_clusters_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(jj, "WORK", 200)
    rows = tables("frames")
    assert sorted((tuple(r) for r in jj.classes(cases.documents(spark, rows), 70, 3).collect()), key=str) == brute(rows, 70, 3)


def test_lower_bound_and_other_sizes(spark):
    rows = tables("hot")
    assert sorted((tuple(r) for r in jj.classes(cases.documents(spark, rows), 50, 2).collect()), key=str) == brute(rows, 50, 2)


def test_empty(spark):
    assert jj.digest(cases.documents(spark, [])).count() == 0
    assert [tuple(r) for r in jj.digest(cases.documents(spark, [(1, None), (2, " ")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_prefixes_lengthen_where_candidates_are_many():
    rare, common = np.full(40, 2), np.full(40, 500)
    assert jj.adapt(rare, 40, 85)[0] < jj.adapt(common, 40, 85)[0]
    for m in (rare, common, np.sort(np.random.default_rng(1).integers(2, 90, 60))):
        ask, long = jj.adapt(m, len(m) + 3, 85)
        assert 1 <= ask <= jj.overlap(len(m) + 3, 85) and long == len(m) - jj.overlap(len(m) + 3, 85) + ask <= len(m)


def test_chance_ties_take_no_rounds(spark, monkeypatch):
    """Documents that only share passages make one cluster, however few of them are linked; their bits take it apart."""
    monkeypatch.setattr(jj, "MEMBERS", 6)
    monkeypatch.setattr(jj, "BLOCK", 4)

    def rounds(*_):
        raise AssertionError("rounds")

    monkeypatch.setattr(jj, "rounds", rounds)
    rows = []
    for i in range(40):
        words = f"{cases.prose(400 + i, 60)} {cases.prose(500 + i // 8, 25)} {cases.prose(600 + (i + 4) // 8, 25)}".split()
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            rows.append((100 + i, " ".join([*words[:50], "other", *words[51:]])))
    got = sorted((tuple(r) for r in jj.classes(cases.documents(spark, rows)).collect()), key=str)
    assert got == brute(rows) and any(c != i for i, _, c in got)


def test_bits_lose_no_link():
    rng = np.random.default_rng(3)
    pool = rng.integers(-(2**63), 2**63 - 1, 4000)
    base = [rng.choice(pool, size, replace=False) for size in (1, 2, 63, 65, 127, 130, 500, 1030)]
    sets = [x[rng.random(len(x)) > rng.choice([0, 0.02, 0.08, 0.2])] for x in base for _ in range(6)]
    sets = [x for x in sets if len(x)]
    own = rng.integers(0, 3, len(sets))  # tokens that no other set has
    n, size, signs = np.array([len(x) for x in sets]) + own, np.array([len(x) for x in sets]), [jj.bits(x) for x in sets]

    def parts(pairs, of):
        comp = list(range(of))
        for a, b in pairs:
            comp = [comp[a] if c == comp[b] else c for c in comp]
        return comp

    for of in (12, len(sets)):  # few, and many at once
        ties = parts(zip(*jj.forest(n[:of], size[:of], signs[:of], 85)), of)
        few = parts(zip(*jj._few(n[:of].tolist(), size[:of].tolist(), signs[:of], 85)), of)
        assert [[x == y for y in ties] for x in ties] == [[x == y for y in few] for x in few]
        for i in range(of):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                assert 100 * both < 85 * (n[i] + n[j] - both) or ties[i] == ties[j]
    assert len(set(ties)) > 4
