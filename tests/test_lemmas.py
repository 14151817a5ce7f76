import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as T

CASES = [
    ("auto|talli", "autotallissa", "autotalli"), ("linja|auto", "linja-autossa", "linja-auto"), ("a|b|c", "a-b-c", "a-b-c"),
    ("maa|talous|tuote", "maatalous-tuotteen", "maatalous-tuote"), ("kesä|ilta", "kesä-illan", "kesä-ilta"), ("itä-saksa|lainen", "itä-saksalaisen", "itä-saksalainen"),
    ("|tuntinen", "tuntisen", "tuntinen"), ("|tuntinen", "-tuntisen", "-tuntinen"), ("alku|", "alku-", "alku-"), ("alku|", "alun", "alku"),
    ("|", "x", "|"), ("||", "x", "||"), ("a|b", "a|b", "a|b"), ("plain", "plain", "plain"), ("-plain", "plain", "-plain"), ("", "x", ""), (None, "x", None), ("a|b", None, None), ("a|b", "", "ab"),
    ("|älä", "-ölä", "älä"),
]


@pytest.mark.parametrize("mark", ["|", "#", "]"])
def test_compound_lemmas(spark, mark):
    cases = [tuple(x and x.replace("|", mark) for x in c) for c in CASES]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, lemma string, word string, want string")
    got = rows.select("*", T.lemma_without_boundaries(F.col("lemma"), mark, F.col("word")).alias("got")).orderBy("i").collect()
    assert [(r["lemma"], r["word"], r["got"]) for r in got] == [(r["lemma"], r["word"], r["want"]) for r in got]


def test_marks_that_stand_for_pipes(spark):
    rows = spark.createDataFrame([("##", "||"), ("#", "|"), ("a#b", "a|b"), ("a#b", "ab")], "lemma string, word string")
    assert [r[0] for r in rows.select(T.lemma_without_boundaries(F.col("lemma"), "#", F.col("word"))).collect()] == ["||", "|", "a|b", "ab"]
