"""Vertical text is put together where its texts were dealt, and read without a row for each token."""

import pytest
from pyspark.sql import functions as F

from spanloom.operators.relation import BadData
from spanloom.plans import catalogue
from spanloom.sources import corpus as C

DOCS = [(2, "Aa <b> cc. Dd\n\nee", "x"), (1, "Ff gg. 12. hh\n...", 'a"&'), (3, None, None), (4, "", ""), (None, "Ii", "n"), (5, "Jj", "p"), (5, "Kk", "q")]


def corpus(spark):
    return C.from_texts(spark.createDataFrame(DOCS, "id long, text string, key string").repartition(3), "id", "text", ["key"])


def test_one_shuffle(spark):
    """Elements of all levels are dealt once, and texts come in order."""
    plan = C.render_vertical(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning") + plan.count("Exchange RoundRobin") and plan.count("Exchange rangepartitioning") == 1
    tokens = catalogue.queries()["vertical_round_trip"](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in tokens._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("arrays", [True, False])
def test_lines(spark, arrays):
    """Texts without words, of no id and of one id; paragraphs without sentences."""
    docs = corpus(spark)
    rows = C.render_vertical(docs if arrays else docs.with_arrays(None)).collect()
    ids = [r["text_id"] for r in rows]
    assert sorted(map(str, ids)) == sorted(str(d[0]) for d in DOCS) and ids == sorted(ids, key=lambda x: (x is not None, x))
    head = "<!-- #vrt positional-attributes: word -->\n"
    of = {r["text_id"]: r["value"].removeprefix(head) for r in rows}
    s = lambda *w: "<sentence>\n" + "".join(f"{x}\n" for x in w) + "</sentence>\n"
    p = lambda *x: "<paragraph>\n" + "".join(x) + "</paragraph>\n"
    assert of[2] == '<text key="x">\n' + p(s("Aa", "b", "cc"), s("Dd")) + p(s("ee")) + "</text>"
    assert of[1] == '<text key="a&quot;&amp;">\n' + p(s("Ff", "gg"), s("hh")) + p() + "</text>"
    assert of[3] == of[4] == '<text key="">\n</text>' and of[None] == '<text key="n">\n</text>'


def test_attributes_of_texts_come_with_tokens(spark, tmp_path, monkeypatch):
    """Without a join, also where a sentence is held in parts, tokens stand outside of sentences, or the text lacks the attribute."""
    monkeypatch.setattr(C, "ROWS", 2)
    (tmp_path / "v.vrt").write_text('<text a="1&amp;" b="x">\n<paragraph>\n<sentence>\nu\nv\nw\n<x/>\ny&lt;\nz\n</sentence>\nout\n</paragraph>\n</text>\n<text b="y">\nq\n<paragraph>\n<sentence>\n</sentence>\n<sentence>\nr\n</sentence>\n</paragraph>\n</text>\n')
    again = C.read_vertical(spark, str(tmp_path), ["word"], of_text=["a"])
    got = sorted(((r["para_no"], r["sent_no"], r["tok_no"], r["word"], r["a"]) for r in again.tokens.collect()), key=lambda r: (r[4] or "", r))
    assert got == [(0, 0, 1, "q", None), (1, 2, 1, "r", None), *((1, 1, i, w, "1&") for i, w in enumerate(["u", "v", "w", "y<", "z", "out"], 1))]
    assert again.sentences.count() == 3 and again.texts.count() == 2
    with pytest.raises(BadData):
        C.read_vertical(spark, str(tmp_path), ["word"], of_text=["word"])
    with pytest.raises(Exception, match="doesn't have 2 fields"):
        C.read_vertical(spark, str(tmp_path), ["word", "pos"]).tokens.agg(F.max("pos")).collect()
