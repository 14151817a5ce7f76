"""Operators that learn: language, toxicity, urls, neighbours."""

import random
import re
import zlib

import numpy as np
from tests.llm import cases

from spanloom.llm import langid, neighbours, queries, toxicity, urls

LETTERS = {"xx": "aeioukl", "yy": "bcdfgh", "zz": "漢字かな"}


def spoken(seed, lang, n):
    r = random.Random(f"{seed}{lang}")
    return " ".join("".join(r.choice(LETTERS[lang]) for _ in range(r.randrange(2, 8))) for _ in range(n))


def test_langid(spark):
    rows = [(i, spoken(i, lang, 3 + i % 40), lang) for i, lang in enumerate(list(LETTERS) * 60)]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "12 !? --", "xx"), (903, "ß", None), (None, "aeio", "xx"), (904, spoken(1, "zz", 60_000), None), (0, rows[0][1], "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS id", "'x' AS score", "2 AS lang_pred")
    got = langid.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by[900], by[901], by[902]] == ["und"] * 3 and by[903] in LETTERS and by[904] == "zz"
    assert np.mean([by[i] == lang for i, _, lang in rows[:180]]) > 0.97
    assert langid.digest(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.digest(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(8)
    terms = sorted({"".join(r.choice("abc") for _ in range(r.randrange(2, 12))) for _ in range(60)})
    found = toxicity.Automaton(terms)
    for _ in range(4000):
        w = "".join(r.choice("abcd") for _ in range(r.randrange(1, 13)))
        fit = sorted((e, i) for i, t in enumerate(terms) if (e := edits(w, t)) <= toxicity.budget(t))
        assert found.match(w) == ((fit[0][1], fit[0][0]) if fit else None), w


def test_quotation_counts_apart():
    reader = toxicity.Reader(["moronic", "scum"], [2.0, 3.0])
    assert reader.features("that moronic thing")[:4] == [2.0, 0, 0, 0]
    assert reader.features("you moronic thing")[:4] == [0, 2.0, 0, 0]
    assert reader.features('the sign “all scum” here')[:4] == [0, 0, 3.0, 0]
    assert reader.features("he wrote scum on it")[:4] == [0, 0, 3.0, 0]
    assert reader.features("mor0nic m0ron morronic (mor.onic), mor-nic")[3] == 8.0
    assert reader.features("scum! scum2 non-scum 1,000 m0onic sc*m")[:4] == [9.0, 0, 0, 0]
    assert toxicity.Reader(["scum"], [3.0], [1]).features("sc*m scam")[3] == 6.0
    assert reader.features("“" + "far away " * 400 + "scum” and “open scum")[:3] == [3.0, 0, 3.0]
    assert reader.features(None) == reader.features("") == reader.features("clean") == [0.0] * 5


def plain_features(text, terms, weights):
    """As the docstring of the operator says, with edit distances to every term, place by place."""
    out = [0.0] * 5
    lower = text.lower()
    words = [(m.start(), m[0]) for m in re.finditer(r"[^\W\d_]+", lower)]
    spans, end = [], -1
    for at, ch in enumerate(lower):
        close = lower.find(toxicity.QUOTES[ch], at + 1) if ch in toxicity.QUOTES and at > end else -1
        if close > 0 and "\n" not in lower[at:close]:
            spans.append((at, close))
            end = close

    def nearest(w):
        fit = sorted((e, i) for i, t in enumerate(terms) if (e := edits(w, t)) <= toxicity.budget(t))
        return fit[0] if fit else None

    for piece in re.finditer(r"\S+", lower):
        found = [(piece.start() + m.start(), n) for m in re.finditer(r"[^\W\d_]+", piece[0]) if (n := nearest(m[0]))]
        core = re.sub(r"^[\W_]+|[\W_]+$", "", piece[0])
        if not found and not core.isalpha() and any(c.isalpha() for c in core) and (n := nearest(core)):
            found = [(piece.start() + piece[0].index(core), n)]
        for at, (e, i) in found:
            before = [w for a, w in words if a < at]
            here = [w for a, w in words if a >= at]
            if e:
                out[3] += weights[i]
            elif any(a < at < b for a, b in spans) or toxicity.REPORTING & set(before[-6:]):
                out[2] += weights[i]
            elif toxicity.SECOND_PERSON & set(before[-6:] + here[:7]):
                out[1] += weights[i]
            else:
                out[0] += weights[i]
            if not e:
                out[4] = max(out[4], weights[i])
    return out


def test_score_equals_brute_force(spark):
    r = random.Random(12)
    terms, weights = ["moronic", "scum", "vermin", "blockheadish"], [2.0, 3.0, 1.5, 2.5]
    model = toxicity.Model(terms, weights, [-1.0, 0.7, 0.9, -0.3, 0.4, 0.2])
    pool = "moronic mor0nic moroni scum scvm vermin, verm-in vermin2 blockheedisch you tu said wrote plain words “ ” \" 12 1,5 non-scum x's\n".split(" ")
    rows = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(60)))) for i in range(120)]
    got = {x["doc_id"]: x["score"] for x in toxicity.score(cases.documents(spark, rows), model).collect()}
    for i, t in rows:
        f = plain_features(t, terms, weights)
        z = model.betas[0] + sum(b * np.log1p(x) for b, x in zip(model.betas[1:], f))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9, t


def test_many_terms(spark):
    """More terms than an earlier version kept."""
    words = ["".join(chr(97 + (k // 26**j) % 26) for j in range(4)) + "zzzzq" for k in range(3500)]
    rows = [(i, " ".join(words[(i // 2 * 50 + j) % 3500] for j in range(50))) if i % 2 else (i, f"plain text {i}") for i in range(6000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(6000)], "doc_id long, toxic int").selectExpr("*", "'x' AS id", "1 AS text", "2 AS y")
    assert len(toxicity.fit(cases.documents(spark, rows), labels).terms) == 3500


def test_toxicity(spark):
    r = random.Random(5)
    bad = ["grubblish", "snarkol", "vexpot"]
    rows, marks = [], []
    for i in range(800):
        w = cases.prose(i, 30).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[r.randrange(30)] = r.choice(bad)
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    rows += [(9000, None), (9001, ""), (None, "grubblish"), (9002, "x " * 50_000)]
    docs, labels = cases.documents(spark, rows), spark.createDataFrame([*marks, (9000, 0), (5, None)], "doc_id long, toxic int")
    got = toxicity.digest(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in got)
    by = {x["doc_id"]: x for x in got}
    assert np.mean([by[i]["predicted"] == y for i, y in marks if by[i]["held_out"]]) > 0.97
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and 560 < kept.count() < 640
    assert toxicity.digest(docs.limit(0), labels).count() == 0
    assert {x["predicted"] for x in toxicity.digest(docs, labels.limit(0)).collect()} == {0}


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_urls(spark):
    r = random.Random(6)
    rows = [(i, f"http://{r.choice(['a', 'm.b', 'WWW'])}.example.{r.choice(['com', 'net', 'org'])}/{r.choice(['en', 'fr', 'es', 'de'])}/{r.randrange(999)}{r.choice(['', '?q=://x', '#top', '.html'])}") for i in range(600)]
    rows += [(1, rows[1][1]), (700, None), (701, ""), (702, "no scheme"), (703, "http://"), (704, "http://xnet/es/"), (705, "http://NET/es/x"), (706, "x://a.com"), (707, "x://a.com/"), (708, "ftp://www.example.com/en/"), (None, "http://a.net/fr/"), (709, "http://h?p=/x"), (710, "http://" + "long/" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS html", "1 AS id", "2 AS host", "3 AS score", "4 AS row")
    got = {(x["page_id"], x["host"], x["path"], x["rule"], x["verdict"]) for x in urls.judge(pages, queries.URL_RULES).collect()}
    assert urls.judge(pages, queries.URL_RULES).count() == len(rows)
    for i, url in rows:
        host, path = split_url(url)
        fit = [(len(u), v, u) for v, u in queries.URL_RULES if (host == u.split("/")[0] or host.endswith("." + u.split("/")[0])) and path.startswith("/" + u.split("/", 1)[1])]
        found = [x for x in got if x[:3] == (i, host, path)]
        assert found, url
        if fit:
            assert found[0][3:] == (max(fit)[2], max(fit)[1])
        else:
            assert found[0][3] is None and found[0][4] in ("allow", "block")
    # query and fragment count too
    score = {x["page_id"]: x["score"] for x in urls.judge(spark.createDataFrame([*rows, (900, "http://a.example.org/de/1"), (901, "http://a.example.org/de/1?fr/es/fr/es")], "page_id long, url string"), queries.URL_RULES).collect()}
    assert score[900] != score[901]
    # rules accept all of com and block much of net, so the models should take the rest of net for blocked
    learned = [x[4] for x in got if x[1].endswith("example.net") and x[2][:4] in ("/de/", "/en/")]
    assert np.mean([v == "block" for v in learned]) > 0.9
    assert urls.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_cut_lies_in_the_middle_of_a_gap():
    assert urls.least_error([(-2.0, 0, 9), (-0.5, 0, 3), (0.5, 4, 0), (1.0, 9, 0)]) == 0.0
    assert urls.least_error([(-2.0, 0, 9), (-1.0, 1, 3), (0.25, 4, 0), (0.75, 9, 1)]) == -0.375
    assert urls.least_error([(0.3, 5, 0)]) == urls.least_error([]) == 0.0


def test_url_model_equals_brute_force(spark):
    """Witten-Bell by recursion over dictionaries."""
    r = random.Random(16)
    rows = [("".join(r.choice("ab/x0") for _ in range(r.randrange(1, 12))), r.random() < 0.5) for _ in range(200)]
    counts = {True: {}, False: {}}
    for u, kind in rows:
        u = "^^^" + u + "$"
        for i in range(len(u) - 3):
            counts[kind][u[i : i + 4]] = counts[kind].get(u[i : i + 4], 0) + 1

    def prob(kind, gram):
        c = counts[kind]
        if len(gram) == 1:
            return (sum(n for g, n in c.items() if g[3] == gram) + 1) / (sum(c.values()) + urls.SYMBOLS)
        tails = {}
        for g, n in c.items():
            tails[g[4 - len(gram) :]] = tails.get(g[4 - len(gram) :], 0) + n
        after = {g: n for g, n in tails.items() if g[:-1] == gram[:-1]}
        seen = sum(after.values())
        lower = prob(kind, gram[1:])
        return (tails.get(gram, 0) + len(after) * lower) / (seen + len(after)) if seen else lower

    grams = sorted({*counts[True], *counts[False]})
    counted = spark.createDataFrame([(g, counts[True].get(g, 0), counts[False].get(g, 0)) for g in grams], "gram string, ok long, bad long")
    got = {x["gram"]: x["ratio"] for x in urls.log_ratio(counted).collect()}
    for g in grams:
        assert abs(got[g] - (np.log(prob(True, g)) - np.log(prob(False, g)))) < 1e-9


def test_langid_equals_brute_force(spark):
    """Counts by dictionary, cosines by loop."""
    r = random.Random(18)
    texts = [spoken(i, lang, 1 + i % 30) for i, lang in enumerate(list(LETTERS) * 8)] + ["ab, CD 12 ef\tÄö", "x"]

    def vector(t):
        data = re.sub(rb" +", b" ", bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalpha() else 32 for c in t.encode()))
        out = np.zeros(langid.D)
        for k in (2, 3, 4):
            for i in range(len(data) - k + 1):
                code = int.from_bytes(data[i : i + k], "big")
                out[((code * 0x9E3779B1 + k) * 0x85EBCA6B % (1 << 32)) >> 20] += 1
        return out

    idf = np.linspace(0.1, 3, langid.D).astype(np.float32)
    centroids = np.array([np.abs(np.random.default_rng(k).normal(size=langid.D)) for k in range(5)])
    centroids = (centroids / np.linalg.norm(centroids, axis=1)[:, None]).astype(np.float32)
    names = ["p", "q", "p", "s", "q"]
    got = {x["doc_id"]: x for x in langid.predict(cases.documents(spark, list(enumerate(texts))), langid.Model(names, centroids, idf, 0.5, "p")).collect()}
    for i, t in enumerate(texts):
        v = np.log1p(vector(t)) * idf
        cos = centroids @ (v / max(np.linalg.norm(v), 1e-30))
        per = {x: max(c for c, y in zip(cos, names) if y == x) for x in names}
        if max(per.values()):
            assert got[i]["lang_pred"] == max(per, key=per.get)
        assert abs(got[i]["cosine"] - max(per.values())) < 1e-4 and got[i]["rejected"] == (got[i]["cosine"] < 0.5)


def recall_of(spark, x, step=50):
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.digest(rows).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    y = x / np.linalg.norm(x, axis=1)[:, None]
    cos = y[::step] @ y.T
    cos[np.arange(len(cos)), np.arange(0, len(x), step)] = -9
    want = np.argsort(-cos, axis=1)[:, :5]
    return np.mean([len(got[step * i] & set(w.tolist())) / 5 for i, w in enumerate(want)])


def test_neighbours_without_clusters(spark):
    """Vectors without any structure; cells of a part of them are visited."""
    assert recall_of(spark, np.random.default_rng(7).normal(size=(12_000, 48))) >= 0.9


def test_neighbours_in_clusters(spark, monkeypatch):
    """With clusters, a small part of the vectors is enough."""
    rng, visited = np.random.default_rng(8), []
    plain = neighbours.enough_for
    monkeypatch.setattr(neighbours, "enough_for", lambda *a: visited.append(plain(*a)) or visited[-1])
    x = rng.normal(size=(300, 48))[rng.integers(0, 300, 12_000)] + 0.3 * rng.normal(size=(12_000, 48))
    assert recall_of(spark, x) >= 0.9 and visited[0] < 3000


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:900] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows[7] = (7, None)
    rows[100] = (100, [0.0] * 16)
    rows[11] = (11, [float("nan")] * 16)
    rows[12] = (12, [None] + [1.0] * 15)
    rows[13] = (13, [1.0] * 3)
    rows += [(None, x[3].tolist()), (600, x[500].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label", "2 AS id", "3 AS v", "4 AS ids")
    ok = [i for i in range(3000) if i not in (7, 100, 11, 12, 13)]
    y = x[ok].astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    want = {}
    for i in ok:
        if i % 50 == 0:
            cos = y @ y[ok.index(i)]
            best = sorted((-round(c, 9), j) for c, j in zip(cos, ok, strict=True) if j != i)[:5]
            want[i] = [j for _, j in best]
    got = {}
    for r in neighbours.digest(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want)
    assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in want]) >= 0.9
    assert got[500] == [501, 502, 503, 504, 505] and got[600] == [500, 501, 502, 503, 504]
    exact = {}
    for r in neighbours.search(vectors, vectors.where("vec_id % 50 = 0"), recall=1.0).orderBy("query_id", "rank").collect():
        exact.setdefault(r["query_id"], []).append(r["vec_id"])
    assert exact == want
    assert neighbours.digest(vectors.limit(0)).count() == 0
