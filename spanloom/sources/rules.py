"""Sentences and tokens of running text by rules: abbreviations, initials, numbers with spaces, marks around words.

All rules are regular expressions of Spark's own functions. A sentence ends at an end mark and a space before what may begin
one, and then ends after abbreviations and initials are taken back. Tokens come out of one pass of one expression, whose
alternatives are in the order of the rules; only runs of marks with emphasis in them are cut once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.relation import col
from spanloom.sources.corpus import Corpus

#: Abbreviations that are one token, those after which no sentence ends, marks, and emphasis.
ABBREVIATIONS = ("t.o.m.", "t.ex.", "f.d.", "s.k.", "bl.a.", "Bl.a.", "p.g.a.", "fr.o.m.", "t.f.", "d.v.s.", "dvs.", "St.", "st.", "Kl.", "kl.")
NO_END = ("t.ex.", "bl.a.", "Bl.a.", "s.k.", "f.d.", "p.g.a.", "fr.o.m.", "St.", "kl.", "Kl.")
MARKS = r"""[,;.!?:"”()_*]"""
CAPITAL = "[A-ZÅÄÖ]"


def _any(words: Sequence[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


def split_sentences(paragraph: Column, no_end: Sequence[str] = NO_END) -> Column:
    """An array of sentences. Runs of blanks count as one space."""
    text = F.regexp_replace(F.trim(F.regexp_replace(paragraph, r"[\s\p{Z}]+", " ")), "\n", " ")
    ended = F.regexp_replace(text, rf"""(\S+[ ")]*[.?!]+[ ")]*[ ])(?=[-(" ]*(?:{CAPITAL}|[0-9]))""", "$1\n")
    kept = F.regexp_replace(ended, rf"(?<!\S)((?:{_any(no_end)}|{CAPITAL}\.)[ ])\n", "$1")
    return F.filter(F.transform(F.split(kept, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def split_tokens(sentence: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """An array of tokens: numbers with spaces in them, initials, abbreviations; else words, and the runs of marks before and after each."""
    special = rf"(?<= )(?:\d+(?: \d+)*|{CAPITAL}\.|{_any(abbreviations)})(?= )"
    pattern = rf"{special}|(?<= ){MARKS}+|{MARKS}+(?= )|[Kk]l\.(?=\d)|[^ ]+?(?={MARKS}* )"
    found = F.regexp_extract_all(F.concat(F.lit(" "), F.regexp_replace(sentence, r"[\s\p{Z}]+", " "), F.lit(" ")), F.lit(pattern), F.lit(0))
    one = r"""[.,;:()"”!?]"""
    emphasis = rf"^(?:__\*\*|\*\*__|(?:__|\*\*)(?:{one}|\.\.\.|{one}{{2}})|(?:{one}|\.\.\.)(?:__|\*\*)|{one}(?:__|\*\*){one}|{one}(?:__\*\*|\*\*__))$"
    # two marks before an emphasis stay together, and the emphasis doesn't, in the published results
    two = lambda t: F.rlike(t, F.lit(rf"^{one}{{2}}(?:__|\*\*)$")) & ~F.rlike(t, F.lit(emphasis))
    cut = lambda t: F.when(two(t), F.array(F.substring(t, 1, 2), F.substring(t, 3, 1), F.substring(t, 4, 1))).when(F.rlike(t, F.lit(emphasis)), F.regexp_extract_all(t, F.lit(r"__|\*\*|\.\.\.|."), F.lit(0))).otherwise(F.array(t))
    return F.flatten(F.transform(found, cut))


def from_running_text(docs: DataFrame, id_col: str, text_col: str, attributes: Sequence[str] = ()) -> Corpus:
    """Texts whose lines are paragraphs, cut by the rules; one scan a level, without a shuffle. Null texts have no paragraphs."""
    pairs = [x for a in attributes for x in (F.lit(a), F.coalesce(col(a).cast("string"), F.lit("")))]
    attrs = (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("attrs")
    none = F.create_map().cast("map<string,string>").alias("attrs")
    lines = docs.select(col(id_col).alias("text_id"), F.posexplode(F.split(text_col, "\n")).alias("i", "content"))
    paras = lines.where(F.regexp_replace("content", r"[\s\p{Z}]+", "") != "").select("text_id", (F.col("i") + 1).cast("long").alias("para_no"), "content")
    sents = paras.select("text_id", "para_no", F.posexplode(split_sentences(F.col("content"))).alias("i", "s")).select("text_id", "para_no", (F.col("i") + 1).cast("long").alias("sent_no"), split_tokens(F.col("s")).alias("words"))
    keys = ["text_id", "para_no", "sent_no"]
    tokens = sents.select(*keys, F.posexplode("words").alias("i", "word")).select(*keys, (F.col("i") + 1).cast("long").alias("tok_no"), "word")
    arrays = sents.select(*keys, F.transform("words", lambda w: F.struct(w.alias("word"))).alias("t"))
    return Corpus(docs.select(col(id_col).alias("text_id"), attrs), paras.select("text_id", "para_no", none), sents.select(*keys, none), tokens).with_arrays(arrays)
