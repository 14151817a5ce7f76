import collections
import random
import re
import zlib

import pytest
from tests.llm import cases

from spanloom.llm import spelling
from spanloom.session import Scratch

FOLD = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(rows):
    found = collections.Counter()
    for i, t in rows:
        for w in re.findall(spelling.LETTERS, (t or "")):
            w = w.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute(words):
    around = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(around[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(around[w]), words.get(form[w])) for w, n in words.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def misspelt(seed, n):
    r, out = random.Random(seed), collections.Counter()
    base = ["house", "mouse", "annual", "banana", "aaaaaaa", "ñandúes", "straße", "étudier", "internationalisation"]
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(4)):
            k = r.randrange(len(w))
            r.choice([lambda: w.pop(k), lambda: w.insert(k, r.choice("aéz")), lambda: w.__setitem__(k, r.choice("aßno"))])()
            if not w:
                w = ["a"]
        out["".join(w)] += r.choice([1, 1, 30, 2000])
    return dict(out)


@pytest.mark.parametrize("few", [spelling.FEW, 3])
def test_forms_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(spelling, "FEW", few)
    monkeypatch.setattr(spelling, "HELD", 5)
    words = misspelt(1, 600) | {"": 3, "q": 9, "qu": 50, "qa": 300}
    got = rows_of(spelling.forms(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    assert max(x[4] for x in got) > 5 and any(x[1] and x[1] != x[2] for x in got)


def test_long_words(spark):
    words = {"x" * 3000: 10, "x" * 5 + "y" + "x" * 2994: 100, "z" * 4000 + "a": 7, "q" + "z" * 4000 + "a": 9}
    assert rows_of(spelling.forms(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_each_pair_once(spark):
    words = spark.createDataFrame(list(misspelt(2, 300).items()), "word string, n long")
    pairs = spelling.neighbours(words, Scratch(spark, "spelling"))
    assert pairs.count() == pairs.select("a", "b").distinct().count()


def test_digest_of_texts(spark):
    r = random.Random(3)
    stock = [w for w in misspelt(4, 200) if len(w) > 4] + ["Ünïcödé", "İstanbul", "MIXEDcase"]
    rows = cases.awkward() + [(100 + i, " ".join(r.choice(stock) + r.choice([" ", ",", "7", "\x00", "×"]) for _ in range(200))) for i in range(60)] + [(50, ("wordword" * 600 + " ") * 6)]
    got = rows_of(spelling.digest(cases.documents(spark, rows)))
    assert got == brute(counts(rows)) and len(got) > 50


def test_empty(spark):
    assert spelling.digest(cases.documents(spark, [])).count() == 0
    assert spelling.digest(cases.documents(spark, [(1, None), (2, "rare words only")])).count() == 0


def test_one_word_of_a_third_of_all_rows(spark):
    words = {f"{a}{b}{c}common": 3 + i for i, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "abcdefgh" for c in "abc")}
    got = rows_of(spelling.forms(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
