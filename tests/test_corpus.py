"""Vertical text, elements, fields, functions and repairs on small corpora."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import elements, fields, products, sequential, stats, validate
from spanloom.operators.relation import BadData
from spanloom.sources import corpus as C
from spanloom.sources import formats

VRT = """<!-- #vrt positional-attributes: word lemma -->
<text a="1" b="x &amp; y" n="21">
<paragraph>
<sentence id="1">
Koira\tkoira
haukkuu.Se\thaukkua
</sentence>
<sentence id="2">
A&lt;B\ta
</sentence>
</paragraph>
</text>
<text a="2" n="3">
<paragraph>
<sentence id="3">
Koira\tkoira
</sentence>
<sentence id="4">
</sentence>
</paragraph>
</text>
"""


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vrt") / "a.vrt"
    path.write_text(VRT, encoding="utf-8")
    return C.read_vertical(spark, str(path))


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("v")).first()["v"]


def test_reading(corpus):
    assert corpus.fields == ["word", "lemma"]
    assert [c.count() for c in corpus] == [2, 2, 4, 4]
    first = corpus.texts.orderBy("text_id").first()["attrs"]
    assert first["b"] == "x & y" and first["n"] == "21"
    assert {r["word"] for r in corpus.tokens.collect()} == {"Koira", "haukkuu.Se", "A<B"}


def test_round_trip(spark, corpus, tmp_path):
    C.write_vertical(corpus, str(tmp_path / "out"))
    again = C.read_vertical(spark, str(tmp_path / "out"))
    count = lambda c: sorted(tuple(r) for r in c.tokens.select("para_no", "sent_no", "tok_no", "word", "lemma").collect())
    assert count(again) == count(corpus)
    C.write_vertical(corpus, str(tmp_path / "by"), partition_by="a")
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == ["a=1", "a=2"]
    assert C.nested_json(corpus).count() == 2


def test_elements(spark, corpus):
    assert elements.select(corpus, "text", [("a", "=", "1|7")]).tokens.count() == 3
    assert elements.select(corpus, "text", [("a", "=", "1")], drop=True).tokens.count() == 1
    assert elements.select(corpus, "text", [("zz", "=", "")]).texts.count() == 2
    assert elements.drop_empty(corpus).sentences.count() == 3
    assert elements.with_tokens(corpus, F.col("lemma") == "koira", "sentence").sentences.count() == 2
    unified = elements.unify_attributes(corpus, "text", default="-", first=["n"])
    assert [r["k"] for r in unified.texts.select(F.map_keys("attrs").alias("k")).collect()] == [["n", "a", "b"]] * 2
    table = spark.createDataFrame([("1", "x", 1), ("1", "y", 2)], "k string, new string, line int")
    added = {r["attrs"]["a"]: r["attrs"]["new"] for r in elements.add_attributes(corpus, "text", "a", table, "k").texts.collect()}
    assert added == {"1": "y", "2": ""}
    with pytest.raises(Exception, match="fewer rows"):
        elements.zip_attributes(corpus, "text", spark.createDataFrame([(1, "q")], "o int, v string"), "o").texts.collect()
    ids = [r["attrs"]["id"] for r in elements.add_ids(corpus, "sentence", "id", "s", 3, within=False).sentences.orderBy(*C.KEYS["sentence"]).collect()]
    assert ids == ["s001", "s002", "s003", "s004"]
    assert len({r["attrs"]["id"] for r in elements.random_ids(corpus, "sentence", seed=3).sentences.collect()}) == 4
    masked = elements.mask(corpus, "text", [("a", "=", "1")], keep={"text": ["a"]}, add={"gone": "yes"})
    assert {r["attrs"].get("gone"): sorted(r["attrs"].items()) for r in masked.texts.collect()} == {"yes": [("a", "1"), ("b", "_"), ("gone", "yes"), ("n", "_")], None: [("a", "2"), ("n", "3")]}
    assert sorted(r["attrs"]["id"] for r in masked.sentences.collect()) == ["3", "4", "_", "_"]
    assert masked.tokens.where("word = '_'").count() == 3
    left = elements.remove(corpus, "text", [("a", "=", "1")])
    assert [c.count() for c in left] == [1, 1, 2, 1]
    assert elements.remove(corpus, "paragraph", []).paragraphs.count() == 2  # without attributes they are never tested
    done = elements.compose_ids(corpus, "sentence", "{hash:.4}-{text[a]/1/one/}-{idnum[text]:02d}.{id:03x}", hash_of="x", prefix="s").sentences
    assert sorted(r["attrs"]["id"] for r in done.collect()) == ["s11f6-2-02.003", "s11f6-2-02.004", "s11f6-one-01.001", "s11f6-one-01.002"]
    with pytest.raises(BadData):
        elements.compose_ids(corpus, "text", "{sentence[id]}")
    assert elements.sample(corpus, "sentence", 2, 1).sentences.count() == 2
    summed = elements.sum_sentence_class(corpus, "id", "ids").texts
    assert sorted(r["attrs"]["ids"] for r in summed.collect()) == ["|1:1|2:1|", "|3:1|4:1|"]
    dropped = elements.drop_attributes(corpus, "text", ".*", keep=["a"]).texts
    assert all(list(r["attrs"]) == ["a"] for r in dropped.collect())


def test_sorting(spark):
    docs = spark.createDataFrame([(i, "x", v) for i, v in enumerate(["21", "1", "10", "2", "3"])], "id long, t string, n string")
    corpus = C.from_texts(docs, "id", "t", ["n"])
    order = lambda flags, transform=None: [r["attrs"]["n"] for r in sorted(elements.sort_texts(corpus, [("n", flags)], transform).texts.collect(), key=lambda r: int(r["attrs"]["order"]))]
    assert order("") == ["1", "10", "2", "21", "3"] and order("n") == ["1", "2", "3", "10", "21"] and order("nr") == ["21", "10", "3", "2", "1"]
    assert order("V") == ["1", "2", "3", "10", "21"]
    assert order("n", "value * -1") == ["21", "10", "3", "2", "1"]


def test_fields(corpus):
    assert fields.keep(corpus, ["lemma", "*"], rest="*").fields == ["lemma", "word"]
    assert fields.rename(corpus, {"word": "lemma", "lemma": "word"}).fields == ["lemma", "word"]
    with pytest.raises(BadData):
        fields.rename(corpus, {"word": "lemma/"})
    with pytest.raises(BadData):
        fields.drop(corpus, ["word", "lemma"])
    reset = fields.reset(corpus, ["lemma"], "id", ["1"])
    assert reset.tokens.where("lemma = '_'").count() == 2
    parted = fields.split_after_stop(corpus)
    words = [(r["sent_no"], r["tok_no"], r["word"]) for r in parted.tokens.orderBy(*C.KEYS["token"]).collect()]
    assert words[:5] == [(1, 1, "Koira"), (1, 2, "haukkuu"), (1, 3, "."), (2, 1, "Se"), (3, 1, "A<B")]


def test_functions(spark):
    assert one(spark, T.unescape(F.col("x")), x="&amp;lt; &lt;") == "&lt; <"
    assert one(spark, T.decode_special(T.encode_special(F.col("x"))), x="a b/c|d<>") == "a b/c|d<>"
    assert one(spark, T.set_union(F.col("x"), F.col("y")), x="|b|a|", y="|c|a|") == "|a|b|c|"
    assert one(spark, T.set_value(T.set_items(F.col("x"))), x="|") == "|"
    assert one(spark, T.set_weights(F.col("x")), x="|fin:12|swe|") == {"fin": 12, "swe": 1}
    assert one(spark, T.join_line_hyphens(F.col("x")), x="hyp-\nhen\n 12 \nlinja-\nauto") == "hyphen\nlinja-auto"
    assert one(spark, T.substitute(F.col("x"), "(B)(c)", "$2$1", "i"), x="abcbc") == "acbbc"
    assert one(spark, T.repair_mojibake(F.col("x")), x="pÃ¤ivÃ¤") == "päivä"
    assert one(spark, T.without_diacritics(F.col("x")), x="façadeä") == "facadeä"
    assert one(spark, T.last_instant(F.col("x")), x="190002") == "19000228235959"
    assert one(spark, T.last_instant(F.col("x")), x="2000") == "20001231235959"
    assert one(spark, T.last_instant(F.col("x")), x="2000010112") == "20000101125959"
    assert one(spark, T.first_instant(F.col("x")), x="2000") == "20000101000000"
    assert one(spark, T.publication_year(F.col("x"), F.col("y")), x="no", y="in 1875.") == "1875"
    assert one(spark, T.duration_seconds(F.col("x")), x="1-02:03:04.5") == 93784.5
    assert one(spark, T.finnish_month(F.col("x")), x="Toukokuussa") == 5
    assert one(spark, T.tag_attributes(F.col("x")), x='<text a="1" b="x&amp;y" a="2">') == {"a": "2", "b": "x&y"}
    assert one(spark, T.name_case(F.col("x"), F.col("y")), x="suomi", y="SUOMEN") == "SUOMI"
    assert one(spark, T.redact_long(F.col("x"), 5, "word"), x="päivää") == "[redacted]"
    assert one(spark, T.lemgram(F.col("x"), F.lit("nn")), x="talo") == "talo..nn.1"


def test_split_equals_a_loop(spark):
    r = random.Random(1)
    sizes = [r.randrange(1, 40) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(sizes)), "i long, n long")
    got = [x["part_no"] for x in sorted(elements.split_sizes(rows, ["i"], "n", 100).collect(), key=lambda x: x["i"])]
    want, part, held = [], 1, 0
    for n in sizes:
        if held and held + n > 100:
            part, held = part + 1, 0
        held += n
        want.append(part)
    assert got == want


def walk(rows, most, most_rows, together):
    """(size, key) in order."""
    units = []
    for n, k in rows:
        if together and units and units[-1][2] == k:
            units[-1] = (units[-1][0] + n, units[-1][1] + 1, k)
        else:
            units.append((n, 1, k))
    out, part, held, held_rows = [], 0, None, None
    for n, c, _ in units:
        if held is None or held + n > most or (most_rows and held_rows + c > most_rows):
            part, held, held_rows = part + 1, 0, 0
        held, held_rows = held + n, held_rows + c
        out += [part] * c
    return out


@pytest.mark.parametrize("most, most_rows, together, largest", [(100, 0, False, 40), (100, 7, False, 130), (60, 9, True, 20), (7, 0, True, 5), (10_000, 3, False, 9)])
def test_split_over_many_stretches(spark, most, most_rows, together, largest):
    r = random.Random(most)
    rows = [(r.randrange(largest), r.choice("ab")) for _ in range(3000)]
    df = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate(rows)], "i long, n long, k string")
    found = elements.split_sizes(df, ["i"], "n", most, most_rows, "k" if together else None).collect()
    assert [x["part_no"] for x in sorted(found, key=lambda x: x["i"])] == walk(rows, most, most_rows, together)


def test_threads(spark):
    """A reply chain of 300 posts, an answer to nobody, and a cycle."""
    rows = [(i, i - 1 if i else None) for i in range(300)] + [(400, 399), (401, 400), (500, 501), (501, 500), (502, 501)]
    got = {r["id"]: r["path"] for r in elements.thread_paths(spark.createDataFrame(rows, "i long, p long"), "i", "p", "i").collect()}
    assert len(got) == len(rows) and got[299] == "/".join(map(str, range(300))) and got[401] == "400/401"
    assert got[500] is got[501] is got[502] is None


def sentence(spark, words, **more):
    return spark.createDataFrame([("t", 1, s, i, w) for s, ws in enumerate(words, 1) for i, w in enumerate(ws.split(), 1)], "text_id string, para_no long, sent_no long, tok_no long, word string")


def shown(tokens):
    out = {}
    for r in tokens.orderBy("sent_no", "tok_no").collect():
        out.setdefault(r["sent_no"], []).append(r["word"])
    return [" ".join(v) for v in out.values()]


def test_sentence_breaks(spark):
    """Cases by hand: words on both sides, end marks, initials, dashes with quotes, and what is left in doubt."""
    sents = ["One two", "three four .", "Five A.", "Six", "x - \"", "Anna said", "- \" Meri said", "no (", "more !", "- \" anna", "it 's", "well-known"]
    fates = [r["fate"] for r in sequential.sentence_breaks(sentence(spark, sents)).orderBy("sent_no").collect()]
    assert fates == ["first", "omit", "keep", "doubt", "omit", "alarm", "alarm", "omit", "doubt", "keep", "omit", "doubt"]
    joined = sequential.join_sentences(sentence(spark, ["a b", "c d e", "f", "g h", ". .", "i"]), max_tokens=5)
    assert shown(joined) == ["a b c d e", "f g h . .", "i"]
    assert shown(sequential.join_sentences(sentence(spark, ["a " * 9, "b"]), max_tokens=0)) == ["a " * 9 + "b"]


def test_repairs(spark):
    assert shown(sequential.join_smileys(sentence(spark, ["hi : ) : : ) x = D ;", ": : ) < 3 :) ) 8 )"]))) == ["hi :) : : ) x =D ;", ": : ) <3 :)) 8 )"]
    assert shown(sequential.join_smileys(sentence(spark, [": ) ; )"]).withColumn("sp", F.when(F.col("tok_no") < 3, "SpaceAfter=No").otherwise("_")), spaces="sp")) == [":) ; )"]
    assert shown(sequential.join_sentences(sentence(spark, ["Hän tuli", "ja meni", "Sitten", ") loppu"]))) == ["Hän tuli ja meni Sitten ) loppu"]
    assert shown(sequential.break_sentences(sentence(spark, ["a . B c . d"]), r"[.]", r"\p{Lu}.*")) == ["a .", "B c . d"]
    with pytest.raises(Exception, match="2 words, 1 annotations"):
        class Bad(sequential.Annotator):
            fields = ["x"]

            def annotate(self, words):
                return [["one"]]

        sequential.annotate(sentence(spark, ["a b"]), Bad()).collect()
    polar = sequential.annotate(sentence(spark, ["good day", "bad day", "day"]), sequential.Polarity({"good"}, {"bad"}))
    assert sorted(r["polarity"] for r in polar.collect()) == ["neg", "neut", "pos"]


def languages(spark, rows):
    """rows: language, confidence, words (all of them different, of three letters)."""
    data = [("t", 1, i, x, float(c), 3 * n, n, n, 0) for i, (x, c, n) in enumerate(rows, 1)]
    df = spark.createDataFrame(data, "text_id string, para_no long, sent_no long, lang string, conf double, letters long, words long, types long, capitals long")
    return [r["fixed"] for r in sequential.repair_languages(df).orderBy("sent_no").collect()]


def test_languages(spark):
    sure = ("fin", 3.0, 12)
    # alone: too few words, or few and unsure
    assert languages(spark, [sure, ("swe", 3.0, 1), sure]) == ["fin", "xxx", "fin"]
    assert languages(spark, [sure, ("swe", 0.8, 3), sure]) == ["fin", "xxx", "fin"]
    # a lone one that is long and sure stays, one that is less sure doesn't
    assert languages(spark, [sure, sure, ("swe", 3.2, 30), sure, sure]) == ["fin", "fin", "swe", "fin", "fin"]
    assert languages(spark, [sure, sure, ("swe", 0.95, 21), sure, sure]) == ["fin", "fin", "xxx", "fin", "fin"]
    # but if the text keeps the language elsewhere, it keeps it here
    assert languages(spark, [sure, sure, ("swe", 0.95, 21), sure, sure, ("swe", 3.2, 40), ("swe", 3.2, 40)])[2] == "swe"
    # the last one is judged by the two before it
    assert languages(spark, [sure, sure, ("eng", 0.9, 5)]) == ["fin", "fin", "xxx"]
    # nothing is known of a text's first sentences but themselves
    assert languages(spark, [("eng", 3.0, 12)]) == ["eng"]
    # of nine languages, those as rare as the eighth go
    many = [(x, 5.0, 40) for x in "aabbccddeeffgghi"]
    assert set(languages(spark, many)) == set("abcdefg") | {"xxx"}


def test_name_tags(spark):
    words = "Yhdysvaltain Keskus Oy toimii".split()
    tags = [("EnamexOrgCrp><EnamexLocPpl-B", "|EnamexOrgCrp><EnamexLocPpl-B-0|EnamexLocPpl-F-1|", "B-LOC"), ("_", "|EnamexLocPpl-E-1|", "I-LOC"), ("EnamexOrgCrp-E", "|EnamexOrgCrp-E-0|", "I-ORG"), ("_", "|EnamexLocPpl-E-1|", "I-LOC")]
    tokens = spark.createDataFrame([("t", 1, 1, i, w, *t) for i, (w, t) in enumerate(zip(words, tags), 1)], "text_id string, para_no long, sent_no long, tok_no long, word string, nertag2 string, nertags2 string, nerbio2 string")
    got = [tuple(r)[5:] for r in sequential.repair_joined_names(tokens, "nertag2", "nertags2", "nerbio2").orderBy("tok_no").collect()]
    assert got == [("EnamexOrgCrp-B", "|EnamexOrgCrp-B-0|EnamexLocPpl-B-1|EnamexLocPpl-F-2|", "B-ORG"), ("_", "|EnamexLocPpl-E-1|", "I-ORG"), ("EnamexOrgCrp-E", "|EnamexOrgCrp-E-0|", "I-ORG"), tags[3]]
    assert sequential.hard_sentences(sentence(spark, ["A " * 12, "A " * 11, "x _#_ y", "ftp://a " * 5])).count() == 3


def test_products(spark):
    tokens = sentence(spark, ["John SMITH met John"]).withColumn("tag", F.when(F.rlike("word", F.lit("^(John|SMITH)$")), "PER").otherwise("_")).withColumn("lemma", F.lower("word"))
    assert {(r["name"], r["freq"]) for r in products.name_index(tokens, "tag", "lemma", "word").collect()} == {("John SMITH", 1), ("John", 1)}
    sizes = stats.size_summary(spark.createDataFrame([(1, 3), (5, 1)], "size long, n long")).first()
    assert (sizes["mean"], sizes["q2"], sizes["q4"]) == (2.0, 1, 5)


def test_validation(spark):
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(["<text a=\"1\" a=\"2\">", "a & b", "x<y", "", "<text>", "a\t\tb", "</sentence>", "\x07"])], "file string, nr long, value string")
    found = {(r["nr"], r["issue"]) for r in validate.line_issues(lines).collect()}
    assert {(0, "attribute twice"), (1, "bare &"), (2, "bare <"), (3, "empty"), (5, "empty field"), (7, "control")} <= found
    nested = {(r["nr"], r["issue"]) for r in validate.nesting_issues(lines).collect()}
    assert nested == {(4, "element in itself"), (4, "never ended"), (6, "end without start")}
    assert validate.field_issues(lines).count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "a.conllu").write_text("# c\n1\tA\ta\n2-3\tBC\t_\n2\tB\tb\n\n1\tC\tc\n")
    rows = formats.conll(spark, str(tmp_path / "a.conllu"), ["id", "form", "lemma"]).collect()
    assert sorted((r["form"], r["sent"]) for r in rows) == [("A", 0), ("B", 0), ("C", 1)]
    (tmp_path / "p.txt").write_text("one\nstill\n\n\ntwo & x\n")
    assert [r["content"] for r in formats.paragraphs(spark, str(tmp_path / "p.txt")).collect()] == ["one\nstill", "two & x"]
    (tmp_path / "f.csv").write_text('id,time,body\n1,2020-02-03 04:05:06,"a <b>line</b>\nx"\n')
    posts = formats.forum_messages(formats.forum_csv(spark, str(tmp_path / "f.csv"), ["id", "time", "body"]), "id", "time", "body").first()
    assert (posts["datefrom"], posts["timefrom"]) == ("20200203", "040506")
    with pytest.raises(BadData):
        formats.forum_csv(spark, str(tmp_path / "f.csv"), ["id"])
    (tmp_path / "x.xml").write_text('<r><item k="1"><v>a</v></item><item k="2"><v>b</v></item></r>')
    mapped = formats.by_rules(formats.xml_records(spark, str(tmp_path / "x.xml"), "item", "_k string, v string"), {"key": "_k", "text": "upper(v)"}, "_k > 1")
    assert [tuple(r) for r in mapped.collect()] == [("2", "B")]


def test_markup_sources(spark, tmp_path):
    (tmp_path / "a.eaf").write_text("""<D><TIME_ORDER><TIME_SLOT TIME_SLOT_ID="t1" TIME_VALUE="10"/><TIME_SLOT TIME_SLOT_ID="t2" TIME_VALUE="90"/></TIME_ORDER>
<TIER TIER_ID="main" PARTICIPANT="X"><ANNOTATION><ALIGNABLE_ANNOTATION ANNOTATION_ID="a1" TIME_SLOT_REF1="t1" TIME_SLOT_REF2="t2"><ANNOTATION_VALUE>hei</ANNOTATION_VALUE></ALIGNABLE_ANNOTATION></ANNOTATION></TIER>
<TIER TIER_ID="note"><ANNOTATION><REF_ANNOTATION ANNOTATION_ID="a2" ANNOTATION_REF="a1"><ANNOTATION_VALUE>greeting</ANNOTATION_VALUE></REF_ANNOTATION></ANNOTATION></TIER>
<TIER TIER_ID="more"><ANNOTATION><REF_ANNOTATION ANNOTATION_ID="a3" ANNOTATION_REF="a2"><ANNOTATION_VALUE>loud</ANNOTATION_VALUE></REF_ANNOTATION></ANNOTATION></TIER></D>""")
    got = sorted(tuple(r)[1:] for r in formats.utterances(spark, str(tmp_path / "a.eaf")).collect())
    assert got == [("main", "X", 10, 90, "hei"), ("more", None, 10, 90, "loud"), ("note", None, 10, 90, "greeting")]
    (tmp_path / "s.xml").write_text('<c><sentence id="s1"><token pos="N">talo</token><token pos="V">on</token></sentence></c>')
    assert [(r["tok_no"], r["word"], r["pos"]) for r in formats.sparv_tokens(spark, str(tmp_path / "s.xml"), ["pos"]).collect()] == [(1, "talo", "N"), (2, "on", "V")]
    (tmp_path / "b.tei").write_text("""<TEI xml:lang="fi"><teiHeader><title type="main">Kirja &amp; muuta</title><author>A. <name>B</name></author><date when="1875">n. 1875</date></teiHeader>
<text><body><div><head>Alku</head><p>Rivi<lb/>toinen <hi>vino</hi>.<note>pois</note></p><p> </p></div><lg><l>säe</l></lg></body></text></TEI>""")
    r = formats.tei_texts(spark, str(tmp_path / "b.tei")).first()
    assert (r["title"], r["author"], r["date"], r["lang"]) == ("Kirja & muuta", "A. B", "1875", "fi")
    assert [(p["n"], p["kind"], p["content"]) for p in r["paragraphs"]] == [(1, "head", "Alku"), (2, "p", "Rivi toinen vino ."), (3, "l", "säe")]
    (tmp_path / "p.xml").write_text("""<alto><TextBlock ID="b1"><TextLine><String CONTENT="sana" WC="0.5"/><SP/><String CONTENT="pit" WC="0.7" SUBS_TYPE="HypPart1" SUBS_CONTENT="pitka"/></TextLine><TextLine><String CONTENT="ka" SUBS_TYPE="HypPart2" SUBS_CONTENT="pitka"/></TextLine></TextBlock></alto>""")
    lines = formats.alto_lines(spark, str(tmp_path / "p.xml")).orderBy("line_no").collect()
    assert [r["words"] for r in lines] == [["sana", "pitka"], []] and abs(lines[0]["confidence"] - 0.6) < 1e-9
    (tmp_path / "m.xml").write_text("""<mets xmlns:xlink="http://www.w3.org/1999/xlink"><fileGrp USE="alto"><file ID="f1"><FLocat xlink:href="alto/p.xml"/></file></fileGrp></mets>""")
    assert [(r["id"], r["use"], r["href"]) for r in formats.mets_files(spark, str(tmp_path / "m.xml")).collect()] == [("f1", "alto", "alto/p.xml")]


def test_date_spans(spark):
    def span(x, **how):
        return tuple(one(spark, T.date_span(F.col("x"), **how), x=x))

    assert span("v. 1875") == ("1875", "") and span("20140910/20140915") == ("20140910", "20140915") and span("none") == ("", "")
    assert span("1.2.1999 - 13.12.2001", order="dmy") == ("19990201", "20011213")
    assert span("45", full=False, short_years=True)[0] == "1945" and span("12", full=False, short_years=True)[0] == "2012"
    assert span("2199-01", newest=2100) == ("", "")
    assert tuple(one(spark, T.whole_days(T.date_span(F.col("x"))), x="2000-02")) == ("20000201", "20000229")


def test_streaming(spark, tmp_path):
    from spanloom.streaming import events

    path = str(tmp_path / "in")
    spark.createDataFrame([(1, i, "ab"[i // 3 % 2]) for i in range(9)], "k long, o long, v string").coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("k long, o long, v string").parquet(path)
    q = events.collect_new(stream, str(tmp_path / "out"), str(tmp_path / "cp"), lambda x: x.where("v = 'a'"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    runs = events.tag_runs(stream, "k", "o", "v").writeStream.format("memory").queryName("runs").outputMode("append").trigger(availableNow=True).start()
    runs.awaitTermination(60)
    assert sorted((r["v"], r["first"], r["last"], r["n"]) for r in spark.table("runs").collect()) == [("a", 0, 2, 3), ("b", 3, 5, 3)]


def test_long_chain_is_a_tree(spark):
    rows = [("a", 1, 1, i, i - 1) for i in range(1, 5001)] + [("a", 1, 2, 1, 0), ("a", 1, 2, 2, 3), ("a", 1, 2, 3, 2)]
    tokens = spark.createDataFrame(rows, "text_id string, para_no int, sent_no int, tok_no int, head int")
    assert [tuple(r) for r in validate.tree_issues(tokens, "tok_no", "head").collect()] == [("a", 1, 2, "cycle")]


def test_texts_with_other_stops_and_lines_are_no_copies(spark, tmp_path):
    """deduplicate_content: lines and stops count, as in its SQL."""
    from spanloom.plans import catalogue
    from tests import oracle

    texts = ["a b. c", "a b\nc", "a b. c.", "a b.. c", "\na b. c", "a b. c\n", "a  b? c", "...", "", None, None, "!", "ab. c"]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(r["text_id"] for r in catalogue.deduplicate_content(spark, str(tmp_path)).collect())
    want = sorted(r[0] for r in oracle.connect(str(tmp_path)).sql(catalogue.oracle_sql()["deduplicate_content"]).fetchall())
    assert got == want == [0, 1, 2, 4, 5, 7, 8, 9, 12]


def test_ids_beyond_their_width_stay_whole(spark):
    """add_ids: a number of more digits than the width isn't cut, so ids stay different."""
    corpus = C.from_texts(spark.createDataFrame([(1, "a. " * 1200)], "id long, text string"), "id", "text")
    ids = [r["attrs"]["id"] for r in elements.add_ids(corpus, "sentence", "id", "s", 3).sentences.orderBy(*C.KEYS["sentence"]).collect()]
    assert len(set(ids)) == 1200 and ids[0] == "s001" and ids[-1] == "s1200"


def test_values_are_python_strings_by_slices():
    """Of a batch, only a slice at a time; null and empty values stay."""
    import tracemalloc

    import pyarrow as pa

    values = pa.array([None, "", *("façadeä ǅ ﬁ " * 2000 for _ in range(400))])
    got, most = [], 0
    tracemalloc.start()
    for part in T.sliced(T._strip_marks, values):
        most = max(most, tracemalloc.get_traced_memory()[1])
        got.append(part)
    tracemalloc.stop()
    assert most < values.nbytes / 3
    assert pa.concat_arrays(got).to_pylist() == [None, "", *(["facadeä Dz fi " * 2000] * 400)]
