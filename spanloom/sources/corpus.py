"""Annotated text: texts hold paragraphs hold sentences hold tokens, each level a table with the keys of those above.

* texts(text_id, attrs)
* paragraphs(text_id, para_no, attrs)
* sentences(text_id, para_no, sent_no, attrs)
* tokens(text_id, para_no, sent_no, tok_no, one string column for each field)

Numbers run from 1 within the element above and carry the order; nothing else does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators.relation import BadData, col

LEVELS = ("text", "paragraph", "sentence")
KEYS = {"text": ["text_id"], "paragraph": ["text_id", "para_no"], "sentence": ["text_id", "para_no", "sent_no"], "token": ["text_id", "para_no", "sent_no", "tok_no"]}


class Levels(NamedTuple):
    texts: DataFrame
    paragraphs: DataFrame
    sentences: DataFrame
    tokens: DataFrame


class Corpus(Levels):
    #: Where a source has them: keys of each sentence with tokens, and t, an array of these in order (structs of their fields). The same tokens, before they were a row each; what changes tokens or sentences leaves them out.
    arrays: DataFrame | None = None

    def with_arrays(self, arrays: DataFrame | None) -> Corpus:
        out = self._replace()
        out.arrays = arrays
        return out

    @property
    def fields(self) -> list[str]:
        return [c for c in self.tokens.columns if c not in KEYS["token"]]

    def level(self, name: str) -> DataFrame:
        return {"text": self.texts, "paragraph": self.paragraphs, "sentence": self.sentences, "token": self.tokens}[name]

    def with_level(self, name: str, df: DataFrame) -> Corpus:
        out = self._replace(**{name + "s": df})
        return out.with_arrays(self.arrays) if name in ("text", "paragraph") else out

    def restrict(self, name: str, kept: DataFrame) -> Corpus:
        """Only elements of this level that are in ``kept``, and what lies below them."""
        keys, out = KEYS[name], self._replace()
        for level in (*LEVELS, "token"):
            if len(KEYS[level]) >= len(keys):
                out = out.with_level(level, out.level(level).join(kept.select(*keys).distinct(), keys, "left_semi"))
        return out


def paragraphs_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda p, i: F.struct((i + 1).cast("long").alias("para_no"), p.alias("content"))), lambda p: F.trim(p["content"]) != "")


#: What a token is: runs of letters; or words, numbers, and each mark on its own.
LETTERS = r"(\p{L}+)"
MARKED = r"(\p{L}[\p{L}\p{M}\p{N}]*(?:['’-][\p{L}\p{M}\p{N}]+)*|\p{N}+(?:[.,:]\p{N}+)*|[^\s\p{L}\p{N}])"


def from_texts(docs: DataFrame, id_col: str, text_col: str, attributes: Sequence[str] = (), token: str = LETTERS, stop: str = r"[.!?]+") -> Corpus:
    """Plain texts: lines are paragraphs, stretches between matches of ``stop`` are sentences, matches of ``token`` are tokens. One scan a level, without a shuffle."""
    texts = docs.select(col(id_col).alias("text_id"), F.create_map(*(x for a in attributes for x in (F.lit(a), F.coalesce(col(a).cast("string"), F.lit(""))))).alias("attrs") if attributes else F.create_map().cast("map<string,string>").alias("attrs"))
    paras = docs.select(col(id_col).alias("text_id"), F.explode(paragraphs_of(col(text_col))).alias("p")).select("text_id", "p.*")
    cut = F.filter(F.transform(F.split("content", stop), lambda s, i: F.struct((i + 1).cast("long").alias("sent_no"), F.regexp_extract_all(s, F.lit(token), F.lit(1)).alias("words"))), lambda s: F.size(s["words"]) > 0)
    sents = paras.select("text_id", "para_no", F.explode(cut).alias("s")).select("text_id", "para_no", "s.*")
    tokens = sents.select("text_id", "para_no", "sent_no", F.posexplode("words").alias("pos", "word")).select("text_id", "para_no", "sent_no", (F.col("pos") + 1).cast("long").alias("tok_no"), "word")
    none = F.create_map().cast("map<string,string>").alias("attrs")
    arrays = sents.select("text_id", "para_no", "sent_no", F.transform("words", lambda w: F.struct(w.alias("word"))).alias("t"))
    return Corpus(texts, paras.select("text_id", "para_no", none), sents.select("text_id", "para_no", "sent_no", none), tokens).with_arrays(arrays)


def cuts(text: Column, stop: str = r"[.!?]+") -> Column:
    """Where a text's lines and sentences end, those without words included: w for a sentence with letters, a stop between sentences, a slash between lines. A null text has its own."""
    line = lambda p: F.array_join(F.transform(F.split(p, stop), lambda s: F.when(F.rlike(s, F.lit(r"\p{L}")), "w").otherwise("")), ".")
    return F.coalesce(F.array_join(F.transform(F.split(text, "\n"), line), "/"), F.lit("null"))


def sentence_arrays(corpus: Corpus) -> DataFrame:
    """Keys of each sentence with tokens, and t, an array of its tokens in order: as they were read, or else gathered."""
    if corpus.arrays is not None:
        return corpus.arrays
    item = F.struct("tok_no", *map(col, corpus.fields))
    sents = corpus.tokens.groupBy(*KEYS["sentence"]).agg(F.array_sort(F.collect_list(item)).alias("t"))
    return sents.select(*KEYS["sentence"], F.transform("t", lambda x: F.struct(*(x[f].alias(f) for f in corpus.fields))).alias("t"))


def gathered(tokens: DataFrame | Corpus, fields: Sequence[str]) -> DataFrame:
    """Keys of each sentence and t, its tokens in order as structs of tok_no and these fields. A corpus that has arrays needs no shuffle."""
    if isinstance(tokens, Corpus):
        if tokens.arrays is not None:
            return tokens.arrays.select(*KEYS["sentence"], F.transform("t", lambda x, i: F.struct((i + 1).cast("long").alias("tok_no"), *(x[f].alias(f) for f in fields if f != "tok_no"))).alias("t"))
        tokens = tokens.tokens
    return tokens.groupBy(*KEYS["sentence"]).agg(F.array_sort(F.collect_list(F.struct("tok_no", *(col(f) for f in fields if f != "tok_no")))).alias("t"))


def of_arrays(corpus: Corpus, arrays: DataFrame) -> Corpus:
    """The corpus with these tokens: keys of sentences and t, as in ``Corpus.arrays``."""
    rows = arrays.select(*KEYS["sentence"], F.posexplode("t").alias("pos", "x"))
    return corpus.with_level("token", rows.select(*KEYS["sentence"], (F.col("pos") + 1).cast("long").alias("tok_no"), "x.*")).with_arrays(arrays)


# -- vertical text: a line for each token and tag

NAMES = re.compile(r"<!--\s*(?:#vrt positional-attributes|#vrt positional attributes|Positional attributes):\s*(.*?)\s*-->")


def field_names(spark: SparkSession, path: str, lines: int = 100) -> list[str]:
    """Names from the comments, else v1 to vK by the first token. Files whose comments differ are an error, as their fields don't belong together."""
    rows = spark.read.text(path)
    named = rows.where(F.startswith("value", F.lit("<!--")) & F.rlike("value", F.lit("(?i)positional.attributes:"))).distinct().limit(lines).collect()
    found = {tuple(m[1].split()) for r in named if (m := NAMES.match(r["value"]))}
    if len(found) > 1:
        raise BadData(f"files have different fields: {sorted(found)}")
    if found:
        return list(found.pop())
    head = [r["value"] for r in rows.limit(lines).collect()]
    token = next((x for x in head if x and not x.startswith("<")), "")
    return [f"v{i}" for i in range(1, len(token.split("\t")) + 1)]


#: Tokens (and tags) that a task holds while it parses texts, whatever their sizes.
ROWS = 20_000
_ATTR = re.compile(r'([\w.-]+)="([^"]*)"')
_ENTITY = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


def _plain(x: str) -> str:
    return re.sub("&(lt|gt|quot|apos|amp);", lambda m: _ENTITY[m[1]], x)


def read_vertical(spark: SparkSession, path: str, names: Sequence[str] | None = None, of_text: Sequence[str] = ()) -> Corpus:
    """Each text is a record of its own (cut at its end tag), parsed where it was read. text_id is the file and the text's place in it.

    ``of_text``: attributes of texts that their tokens have as fields, so that they need not be joined.
    """
    names = list(names or field_names(spark, path))
    if off := sorted({n for n in of_text if n in (*names, *KEYS["token"])}):
        raise BadData(f"attributes with names of fields: {off}")
    rows = spark.read.option("lineSep", "</text>\n").text(path).select("value", F.concat_ws("#", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias("text_id"))
    out = "level string, text_id string, para_no long, sent_no long, tok_no long, attrs map<string,string>, own array<string>, t array<array<string>>"
    names_out = [x.split(" ")[0] for x in out.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]

    def parsed(value: str, text_id: str) -> Iterator[tuple]:
        """Tags, and tokens of a sentence together, ``ROWS`` at most; tok_no is that of the first."""
        para = sent = tok = 0
        own: list[str | None] = [None] * len(of_text)
        held: list[list[str]] = []
        tokens = lambda: ("token", text_id, para, sent, tok - len(held) + 1, [], own, held)
        for m in re.finditer(r"[^\n]+", value):  # line by line, without a list of them
            line = m[0].rstrip("\r")
            attrs = lambda: [(k, _plain(v)) for k, v in dict(_ATTR.findall(line)).items()]  # noqa: B023, E731
            if line and not line.startswith("<"):
                tok += 1
                held.append([_plain(v) for v in line.split("\t")] if "&" in line else line.split("\t"))
                if len(held) == ROWS:
                    yield tokens()
                    held = []
            elif line.startswith(("<text", "<paragraph", "<sentence")):
                if held:
                    yield tokens()
                    held = []
                if line.startswith("<text"):
                    found = attrs()
                    own = [dict(found).get(n) for n in of_text]
                    yield "text", text_id, 0, 0, 0, found, [], []
                elif line.startswith("<paragraph"):
                    para, sent, tok = para + 1, 0, 0
                    yield "paragraph", text_id, para, 0, 0, attrs(), [], []
                else:
                    sent, tok = sent + 1, 0
                    yield "sentence", text_id, para, sent, 0, attrs(), [], []
        if held:
            yield tokens()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*part, strict=True), kinds, strict=True)], names_out)
        for b in batches:
            for value, text_id in zip(b.column(0), b.column(1), strict=True):
                for row in parsed(value.as_py(), text_id.as_py()):
                    part.append(row)
                    n += max(1, len(row[-1]))
                    if n >= ROWS:
                        yield batch()
                        part, n = [], 0
        if part:
            yield batch()

    lines = rows.mapInArrow(parse, out)
    of = lambda level: lines.where(F.col("level") == level)
    whole = F.when(F.size("f") == len(names), F.col("f")).otherwise(F.raise_error(F.lit(f"a token doesn't have {len(names)} fields")).cast("array<string>"))
    own = [F.get("own", F.lit(i)).alias(n) for i, n in enumerate(of_text)]
    tokens = of("token").select(*KEYS["sentence"], "own", F.col("tok_no").alias("first"), F.posexplode("t").alias("i", "f")).select(*KEYS["sentence"], "own", (F.col("first") + F.col("i")).alias("tok_no"), whole.alias("f"))
    tokens = tokens.select(*KEYS["token"], *(F.element_at("f", i).alias(n) for i, n in enumerate(names, 1)), *own)
    return Corpus(of("text").select("text_id", "attrs"), of("paragraph").select("text_id", "para_no", "attrs"), of("sentence").select(*KEYS["sentence"], "attrs"), tokens)


def render_vertical(corpus: Corpus) -> DataFrame:
    """value: each text as lines with tags, in one row, in order of text_id over the partitions.

    Elements of all levels, sentences as their lines, are dealt by ranges of texts once, and a sentence, then a paragraph, then a text is put together where it lies.
    """
    token = lambda x: F.concat_ws("\t", *(T.escape_field(F.coalesce(x[f], F.lit("_"))) for f in corpus.fields))
    none = lambda kind: F.lit(None).cast(kind)
    keys = KEYS["sentence"]
    kinds = dict(corpus.sentences.dtypes)
    rows = gathered(corpus, corpus.fields).select(*keys, F.lit(3).alias("level"), none("string").alias("tag"), F.array_join(F.transform("t", token), "\n").alias("body"))
    for n, level in enumerate(LEVELS, 1):
        own = [F.col(k) if k in KEYS[level] else none(kinds[k]).alias(k) for k in keys]
        rows = rows.union(corpus.level(level).select(*own, F.lit(n), T.start_tag(level, F.col("attrs")).alias("tag"), none("string")))
    rows = rows.repartitionByRange("text_id")

    def elements(level: str, inner: Column) -> Column:
        """Lines of the elements with these keys: each start tag, and within it each body that there is."""
        body = F.when(F.size(inner) > 0, inner).otherwise(F.array(none("string")))
        return F.flatten(F.transform("tags", lambda t: F.transform(body, lambda x: F.concat(t, F.lit("\n"), F.coalesce(F.concat(x, F.lit("\n")), F.lit("")), F.lit(f"</{level}>")))))

    sents = rows.groupBy(*keys, "level").agg(F.collect_list("tag").alias("tags"), F.collect_list("body").alias("bodies"))
    sents = sents.select(*keys, "level", "tags", F.when(F.col("level") == 3, elements("sentence", F.col("bodies"))).alias("lines"))
    joined = lambda of: F.when(F.size(of) > 0, F.array(F.array_join(F.flatten(F.transform(F.array_sort(of), lambda x: x["lines"])), "\n"))).alias("inner")
    tags = lambda k: F.flatten(F.collect_list(F.when(F.col("level") == k, F.col("tags")))).alias("tags")
    below = lambda k, nr: F.collect_list(F.when((F.col("level") == k) & (F.size("lines") > 0), F.struct(nr, "lines")))
    paras = sents.groupBy("text_id", "para_no").agg(F.flatten(F.collect_list(F.when(F.col("level") < 3, F.col("tags")))).alias("tags"), below(3, "sent_no").alias("s"))
    paras = paras.select("text_id", "para_no", "tags", joined(F.col("s")), F.when(F.col("para_no").isNotNull(), 2).otherwise(1).alias("level"))
    paras = paras.select("text_id", "para_no", "tags", "level", F.when(F.col("level") == 2, elements("paragraph", F.col("inner"))).alias("lines"))
    # a text whose id is null holds nothing
    texts = paras.groupBy("text_id").agg(tags(1), below(2, "para_no").alias("s")).select("text_id", "tags", joined(F.when(F.col("text_id").isNotNull(), F.col("s"))))
    head = F.lit(f"<!-- #vrt positional-attributes: {' '.join(corpus.fields)} -->\n")
    lines = texts.select("text_id", F.explode(elements("text", F.col("inner"))).alias("line"))
    return lines.sortWithinPartitions("text_id").select("text_id", F.concat(head, "line").alias("value"))


def write_vertical(corpus: Corpus, path: str, partition_by: str | None = None, compression: str = "none") -> None:
    """Text files, in order of text_id; with ``partition_by`` a text attribute's values are folders. Nothing is overwritten."""
    rows = render_vertical(corpus)
    if partition_by:
        rows = rows.join(corpus.texts.select("text_id", F.coalesce(F.col("attrs")[partition_by], F.lit("")).alias(partition_by)), "text_id")
        rows.select("value", partition_by).write.mode("errorifexists").option("compression", compression).partitionBy(partition_by).text(path)
    else:
        rows.select("value").write.mode("errorifexists").option("compression", compression).text(path)


def flat_sentences(corpus: Corpus, spans: DataFrame) -> DataFrame:
    """As ``flat``, but keys of each sentence with tokens and t, an array of structs of tok_no, the fields, before and after."""
    keys = KEYS["sentence"]
    tags = spans.where("first IS NOT NULL OR last IS NOT NULL").groupBy(*keys).agg(F.collect_list(F.struct("first", "last", "tag")).alias("s"))
    # what opens or closes there: at a token, the longer span is outside
    opens = lambda s, nr: F.array_sort(F.transform(F.filter(s, lambda x: x["first"] == nr), lambda x: F.struct((-x["last"]).alias("o"), x["tag"].alias("tag"))))
    closes = lambda s, nr: F.array_sort(F.transform(F.filter(s, lambda x: x["last"] == nr), lambda x: F.struct((-x["first"]).alias("o"), x["tag"].alias("tag"))))
    names = lambda l: F.transform(l, lambda x: x["tag"])
    s = F.coalesce("s", F.array().cast(tags.schema["s"].dataType))
    token = lambda x: F.struct(*(x[c].alias(c) for c in ("tok_no", *corpus.fields)), names(opens(F.col("s"), x["tok_no"])).alias("before"), names(closes(F.col("s"), x["tok_no"])).alias("after"))
    return gathered(corpus, corpus.fields).join(tags, keys, "left").select(*keys, "t", s.alias("s")).select(*keys, F.transform("t", token).alias("t"))


def flat(corpus: Corpus, spans: DataFrame) -> DataFrame:
    """Tokens with a field for the markup inside sentences. spans: text_id, para_no, sent_no, first, last, tag. Adds before and after, arrays of tags."""
    return flat_sentences(corpus, spans).select(*KEYS["sentence"], F.explode("t").alias("x")).select(*KEYS["sentence"], "x.*")


def deep_sentences(sentences: DataFrame, fields: Sequence[str], markup: Sequence[str] = ("before", "after")) -> DataFrame:
    """The inverse of ``flat_sentences``, as lines: keys of the sentence, line_no, line; tags stand between tokens again. Nothing is shuffled."""
    token = lambda x: F.concat_ws("\t", *(T.escape_field(F.coalesce(x[f], F.lit("_"))) for f in fields))
    ends = lambda x: F.transform(x[markup[1]], lambda t: F.concat(F.lit("</"), F.regexp_extract(t, r"^<([^ >/]+)", 1), F.lit(">")))
    lines = F.flatten(F.transform("t", lambda x: F.concat(x[markup[0]], F.array(token(x)), ends(x))))
    return sentences.select(*KEYS["sentence"], F.posexplode(lines).alias("i", "line")).select(*KEYS["sentence"], (F.col("i") + 1).alias("line_no"), "line")


def deep(tokens: DataFrame, fields: Sequence[str], markup: Sequence[str] = ("before", "after")) -> DataFrame:
    """The inverse of ``flat``, as lines: keys of the sentence, line_no, line; tags stand between tokens again."""
    return deep_sentences(gathered(tokens, [*fields, *markup]), fields, markup)


def nested_json(corpus: Corpus) -> DataFrame:
    """text_id, json: a text's attributes and, below data, its paragraphs, sentences and tokens.

    What lies below texts is dealt by text once, elements of all levels together, and nested where it lies.
    """
    tokens = gathered(corpus, corpus.fields)
    none = lambda kind: F.lit(None).cast(kind)
    kind, attrs = tokens.schema["t"].dataType, "map<string,string>"
    below = tokens.select(*KEYS["sentence"], none(attrs).alias("attrs"), F.col("t").alias("data"), F.lit(False).alias("own"))
    below = below.union(corpus.sentences.select(*KEYS["sentence"], F.col("attrs").cast(attrs), none(kind), F.lit(True)))
    below = below.union(corpus.paragraphs.select("text_id", "para_no", none("bigint"), F.col("attrs").cast(attrs), none(kind), F.lit(True)))
    one = lambda c: F.when(F.size(c) > 0, F.when(F.size(c) == 1, F.col(c)[0]).otherwise(F.array_sort(F.flatten(c))))
    own = F.collect_list(F.when(F.col("own"), F.struct(F.to_json("attrs").alias("attrs")))).alias("own")
    rows = below.repartition("text_id").groupBy(*KEYS["sentence"]).agg(own, F.collect_list("data").alias("d")).select(*KEYS["sentence"], "own", one("d").alias("data"))
    sent = F.transform("own", lambda x: F.struct("sent_no", x["attrs"].alias("sent"), "data"))
    last = F.col("sent_no").isNull()
    paras = rows.groupBy(*KEYS["paragraph"]).agg(F.flatten(F.collect_list(F.when(last, F.col("own")))).alias("own"), F.array_sort(F.flatten(F.collect_list(F.when(~last, sent)))).alias("s"))
    paras = paras.select(*KEYS["paragraph"], F.transform("own", lambda x: F.struct("para_no", x["attrs"].alias("para"), F.when(F.size("s") > 0, F.col("s")).alias("data"))).alias("p"))
    data = paras.groupBy("text_id").agg(F.array_sort(F.flatten(F.collect_list("p"))).alias("p")).where(F.size("p") > 0).select("text_id", F.col("p").alias("data"))
    return corpus.texts.join(data, "text_id", "left").select("text_id", F.to_json(F.struct(F.col("attrs").alias("text"), "data")).alias("json"))


def check_fields(corpus: Corpus, names: Sequence[str]) -> None:
    if off := [n for n in names if n not in corpus.fields]:
        raise BadData(f"no such fields: {off}")
