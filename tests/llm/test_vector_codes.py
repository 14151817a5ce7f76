import hashlib
import math
import random

import pytest

from spanloom.llm import vector_codes as vc


def brute(rows):
    """rows: (vec_id, vector, label), of one length that 16 divides."""
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 16
    part = lambda v, p: v[p * width : (p + 1) * width]
    seeds = sorted((x for x in kept if x[0] is not None), key=lambda x: x[:2])[:64]
    books = [[part(v, p) for _, v, _ in seeds] for p in range(16)]

    def assign():
        out = []
        for _, v, _ in kept:
            found = [min((sum((a - b) ** 2 for a, b in zip(part(v, p), e)), k) for k, e in enumerate(books[p])) for p in range(16)]
            out.append(([k for _, k in found], sum(d for d, _ in found)))
        return out

    for _ in range(2):
        codes = assign()
        for p in range(16):
            for k in range(len(books[p])):
                own = [part(v, p) for (_, v, _), (c, _) in zip(kept, codes) if c[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    codes = assign()
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    total = {}
    for (_, _, l), (_, e) in zip(kept, codes):
        total[l] = total.get(l, 0) + e
    long = lambda x: x if x < 1 << 63 else None
    return sorted(((i, "".join(f"{k:02x}" for k in c), long(e), long(total[l]), sha) for (i, _, l), (c, e) in zip(kept, codes)), key=str)


def vectors(n, size, seed, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(i % 7, spread) for _ in range(size)], None if i % 5 == 0 else i % 3) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, id string, code int")


@pytest.mark.parametrize("kind", ["plain", "few", "awkward", "huge", "odd width"])
def test_equals_brute_force(spark, kind):
    rows = vectors(40 if kind == "few" else 300, 48 if kind == "odd width" else 32, 3)
    if kind == "awkward":
        rows += [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, None), (903, [float("inf")] * 32, 2), (7, rows[7][1], 1), (7, rows[9][1], 1), (None, rows[3][1], 2), (904, [0.0] * 32, None)]
        rows += [(1000 + i, rows[11][1], 2) for i in range(150)]  # one vector and label that a third of all rows share
    if kind == "huge":
        rows += [(400 + i, [x * 10.0 ** (3 * i) for x in v], 1) for i, (_, v, _) in enumerate(rows[:7])]
    got = sorted((tuple(r) for r in vc.digest(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i // 2)] * 16, 0) for i in range(10)]  # entries 2k and 2k + 1 are equal
    assert {r.code[:2] for r in vc.digest(frame(spark, rows)).collect()} == {"00", "02", "04", "06", "08"}


def test_empty_and_short(spark):
    assert vc.digest(frame(spark, [])).count() == 0
    assert vc.digest(frame(spark, [(1, None, 2)])).count() == 0
    assert [tuple(r)[:4] for r in vc.digest(frame(spark, [(1, [], None), (2, [0.5], None), (3, [0.25, 1.0], 4)])).orderBy("vec_id").collect()] == [(1, "00" * 16, 0, 0), (2, "01" + "00" * 15, 0, 0), (3, "0202" + "00" * 14, 0, 0)]


def test_null_ids_alone(spark):
    assert [tuple(r)[:3] for r in vc.digest(frame(spark, [(None, [1.0] * 16, 1)])).collect()] == [(None, "00" * 16, 0)]


def test_transform_keeps_distances():
    import numpy as np

    r = np.random.default_rng(1)
    x, y = r.integers(-500, 500, (20, 6)), r.integers(-500, 500, (9, 6))
    order = vc.sequency(8)
    assert sorted(order.tolist()) == list(range(8))
    code, distance = vc.nearest(vc.transform(x, order), vc.transform(y, order))
    plain = ((x[:, None] - y) ** 2).sum(axis=2)
    assert (code == plain.argmin(axis=1)).all() and (distance == 8 * plain.min(axis=1)).all()


def test_decode(spark):
    rows = vc.usable(frame(spark, vectors(50, 32, 4)), "vec_id", "embedding", "label")
    books = vc.fit(rows)
    for r in vc.decode(vc.encode(rows, books), books).join(rows.select("id", "v"), "id").collect():
        assert sum((math.floor(256 * a) - round(256 * b)) ** 2 for a, b in zip(r.v, r.approximation)) == r.error
