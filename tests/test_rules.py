import pytest
from pyspark.sql import functions as F

from spanloom.sources import rules


def shown(spark, text):
    corpus = rules.from_running_text(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text")
    out = {}
    for r in corpus.tokens.orderBy("para_no", "sent_no", "tok_no").collect():
        out.setdefault((r["para_no"], r["sent_no"]), []).append(r["word"])
    return ["|".join(v) for v in out.values()]


CASES = {
    "Det kostar 12 000 kronor.": ["Det|kostar|12 000|kronor|."],
    "George W. Bush var där. Han gick.": ["George|W.|Bush|var|där|.", "Han|gick|."],
    "Vi ses kl. 18. Kom t.ex. Anna?": ["Vi|ses|kl.|18|.", "Kom|t.ex.|Anna|?"],
    "(kl.18-17.30) är det": ["(|kl.|18-17.30|)|är|det"],
    'Han sa: "Nej!" Sedan gick han.': ['Han|sa|:|"|Nej|!"', "Sedan|gick|han|."],
    "Se __Aftonbladet__, och **nu**.": ["Se|__|Aftonbladet|__|,|och|**|nu|**|."],
    'nu!"__ x': ["nu|!\"|_|_|x"],
    "slut...__ (__) x": ["slut|...|__|(|__|)|x"],
    "e-post@x.se, A.B.C. och 3.5": ["e-post@x.se|,|A.B.C|.|och|3.5"],
    "Ja. nej. - Så! 5 till": ["Ja|.|nej|.", "-|Så|!", "5|till"],
    "a  b\tc\n\n \nSt. Petersburg": ["a|b|c", "St.|Petersburg"],
    "": [],
}


@pytest.mark.parametrize("text", CASES)
def test_cases_by_hand(spark, text):
    assert shown(spark, text) == CASES[text]


def test_nothing_but_blanks_is_lost(spark):
    texts = [*CASES, "?!\"') ** _ 1 2 3 4. 5", '" . " Å', ". . . A", "…”“ x.y.Z. 12 x 12 ."]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    flat = lambda c: F.regexp_replace(c, r"[\s\p{Z}]+", "")
    again = F.array_join(F.flatten(F.transform(rules.split_sentences(F.col("t")), lambda s: rules.split_tokens(s))), "")
    assert docs.where(flat("t") != flat(again)).count() == 0
