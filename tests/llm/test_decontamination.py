import hashlib
import re

import pytest
from tests.llm import cases

from spanloom.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9)) if w else ():
            wins.setdefault(tuple(w[s : s + 10]), set()).add(str(i))
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if (x := tuple(w[s : s + n])) in wins:
                    hit |= set(range(s, s + n))
                    found |= wins[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def fixture():
    rows = cases.awkward()
    base = cases.prose(1, 120).split()
    items = [(1, " ".join(base[5:40])), (2, cases.prose(2, 30)), (3, "Short   ONE"), (4, ""), (5, None), (10, " ".join(base[50:59])), (11, cases.prose(77, 12)), (3, "xi1"), (12, " ".join(base[30:52]).upper())]
    rows = rows + [(50, cases.prose(9, 20) + " " + " ".join(base[5:15])), (51, " ".join(base[5:14])), (52, "same same same " * 9), (53, "漢字 " + base[7].upper())]
    items.append((20, "same " * 11))
    return rows, items


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_equals_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(dc, "BLOCK_WORDS", block_words)
    rows, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id", "'x' AS item", "2 AS g", "3 AS key", "4 AS words")
    docs = cases.documents(spark, rows)
    assert sorted(map(tuple, dc.digest(docs, bench).collect()), key=str) == brute(rows, items)
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in brute(rows, items) if not r[5])


def test_empty_tables(spark):
    rows, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = cases.documents(spark, rows)
    assert dc.digest(docs.limit(0), bench).count() == 0
    assert dc.digest(docs, bench.limit(0)).where("contaminated").count() == 0
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


@pytest.mark.parametrize("block_words", [2_000_000, 0])
def test_random(spark, monkeypatch, block_words):
    import random

    monkeypatch.setattr(dc, "BLOCK_WORDS", block_words)
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(60)))) for i in range(200)]
    items = [(i, " ".join(r.choice("abc") for _ in range(r.choice([3, 7, 10, 11, 14, 30])))) for i in range(40)]
    got = dc.digest(cases.documents(spark, rows, extra=False), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)
