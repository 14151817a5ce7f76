"""Queries that take sentences as the arrays that they were read as, and deal them at most once."""

import pytest
from pyspark.sql import functions as F

from spanloom.operators import elements, markup
from spanloom.plans import catalogue
from spanloom.sources import corpus as C


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def corpus(spark, rows):
    return C.from_texts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")


def gathered_again(corpus):
    """The same, without the arrays."""
    return corpus.with_arrays(None)


DOCS = [(1, "Aa bb Cc. Dd\n\nee"), (2, None), (3, ""), (None, "Ff gg"), (4, "x. Hh ii Jj kk Ll mm. nn\nOo")]


@pytest.mark.parametrize(("name", "most"), [("flat_and_deep", 2), ("json_rows", 2), ("name_elements", 8)])
def test_shuffles(spark, name, most):
    assert exchanges(catalogue.queries()[name](spark, "/root/testdata/sf0.001")) <= most


def test_seeds_move_counts_of_texts_only(spark):
    """All seeds come without a shuffle; chosen ones are those of the whole order."""
    many = corpus(spark, DOCS + [(i, "Aa bb cc dd ee. ff gg hh\nii jj kk ll") for i in range(10, 60)])
    every = elements.seeds(many, 2, 2)
    assert exchanges(every) == 0
    rows = every.orderBy("text_id", "para_no", "sent_no", "seed_no").collect()
    for most in (1, 7, 50, len(rows), 1000):
        want = [r for i, r in enumerate(rows, 1) if i * most // len(rows) > (i - 1) * most // len(rows)] if most < len(rows) else rows
        assert sorted(map(str, elements.seeds(many, 2, 2, most=most).collect())) == sorted(map(str, want))


def test_json_is_whole(spark):
    """Null ids are not merged, texts of one id keep their paragraphs, and arrays give what gathered tokens give."""
    docs = corpus(spark, [*DOCS, (None, "Pp"), (5, "qq. rr"), (5, "ss tt\nuu")])
    got = [(r["text_id"], r["json"]) for r in C.nested_json(docs).collect()]
    assert [i for i, _ in got].count(None) == 2 and [i for i, _ in got].count(5) == 2 and len(got) == len(DOCS) + 3
    of = dict(got)
    assert of[1] == '{"text":{},"data":[{"para_no":1,"para":"{}","data":[{"sent_no":1,"sent":"{}","data":[{"tok_no":1,"word":"Aa"},{"tok_no":2,"word":"bb"},{"tok_no":3,"word":"Cc"}]},{"sent_no":2,"sent":"{}","data":[{"tok_no":1,"word":"Dd"}]}]},{"para_no":3,"para":"{}","data":[{"sent_no":1,"sent":"{}","data":[{"tok_no":1,"word":"ee"}]}]}]}'
    assert of[2] == of[3] == '{"text":{}}'
    assert all(f'"word":"{w}"' in of[5] for w in ("qq", "rr", "ss", "tt", "uu"))
    some = lambda c: sorted(map(str, C.nested_json(c).where("text_id < 5").collect()))
    assert some(docs) == some(gathered_again(docs))


def test_flat_and_names_from_arrays(spark):
    docs = corpus(spark, [r for r in DOCS if r[0]])
    arrays = docs.arrays.select(*C.KEYS["sentence"], F.transform("t", lambda x: F.struct(x["word"], F.lower(x["word"]).alias("lemma"), F.when(F.rlike(x["word"], F.lit("^[A-Z]")), "|EnamexPrsHum-F-0|").otherwise("_").alias("nertags"))).alias("t"))
    tagged = C.of_arrays(docs, arrays)
    names = lambda t: markup.name_elements(t, markup.name_spans(t)[0])
    of_arrays, of_tokens = names(tagged), names(tagged.tokens)
    assert sorted(map(str, of_arrays.collect())) == sorted(map(str, of_tokens.collect()))
    assert of_arrays.count() == 7
    lines = lambda c: sorted(map(str, C.deep(C.flat(c, of_arrays), ["word"]).collect()))
    assert lines(tagged) == lines(gathered_again(tagged)) == sorted(map(str, C.deep_sentences(C.flat_sentences(tagged, of_arrays), ["word"]).collect()))


@pytest.mark.parametrize("name", ["tags_put_back", "tag_warnings"])
def test_tags_are_placed_without_a_shuffle(spark, name):
    """Only what is counted at the end is dealt."""
    assert exchanges(catalogue.queries()[name](spark, "/root/testdata/sf0.001")) <= 1


def test_tags_of_texts_and_of_rows(spark):
    """Arrays give what rows give, also for texts without tokens, tags or text, and whatever other columns there are."""
    docs = spark.createDataFrame([(1, "a<b>b cc</b> d\n<i/>e</i>"), (2, ""), (3, None), (4, "<b></b>"), (5, "no tags"), (6, "x <!-- y --> <b>é\U0001f600 z")], "text_id long, text string")
    texts = markup.encode_texts(docs)
    tokens = F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""), lambda w, i: F.struct((i + 1).cast("long").alias("tok_no"), w.alias("word")))
    of_texts = markup.place_texts(texts.select("text_id", F.lit("o").alias("other"), tokens.alias("t"), "tags")).select("text_id", F.inline("tags"))
    of_rows = markup.place_tags(texts.select("text_id", F.inline(tokens)), markup.encode_tags(docs)[1])
    assert of_texts.columns == of_rows.columns and sorted(map(str, of_texts.collect())) == sorted(map(str, of_rows.collect()))
    got = {(r["text_id"], r["tag_no"]): r for r in of_rows.collect()}
    assert (got[1, 1]["token"], got[1, 1]["within"], got[1, 1]["end_of"], got[1, 1]["end_token"]) == (1, 1, 2, 3)
    assert got[1, 4]["spurious"] and got[1, 3]["opens"] is None and (got[6, 2]["left"], got[6, 2]["right"], got[6, 2]["offset"]) == ("x", "é\U0001f600z", 1)
