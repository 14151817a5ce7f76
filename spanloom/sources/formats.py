"""Other sources of annotated and plain text, each read by a Spark reader and shaped by expressions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators.relation import BadData

#: The ten columns of CoNLL-U and the first eight of CoNLL-X.
CONLLU = "id form lemma upos xpos feats head deprel deps misc".split()
CONLLX = "id form lemma cpos pos feats head deprel".split()


def plain_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: path, content (escaped for use in elements)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), T.escape_field(F.col("value")).alias("content"))


def paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """path, para_no, content: stretches between blank lines."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.filter(F.split(F.replace("value", F.lit("\r\n"), F.lit("\n")), r"\n[ \t]*(?:\n[ \t]*)+"), lambda p: F.trim(p) != "").alias("p"))
    return whole.select("path", F.posexplode("p").alias("i", "content")).select("path", (F.col("i") + 1).alias("para_no"), F.regexp_replace("content", r"^\n+|\n+$", "").alias("content"))


def conll(spark: SparkSession, path: str, columns: Sequence[str] = CONLLU) -> DataFrame:
    """Blank-line separated sentences: file, sent (rises in a file), comments, and a row for each token with the columns. A sentence is a record; ranges and empty nodes are left out."""
    rows = spark.read.option("lineSep", "\n\n").text(path).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("sent"), F.split("value", "\r?\n").alias("lines"))
    rows = rows.select("file", "sent", F.filter("lines", lambda x: F.startswith(x, F.lit("#"))).alias("comments"), F.explode(F.filter("lines", lambda x: F.rlike(x, F.lit(r"^[0-9]+\t")))).alias("line"))
    parts = F.split("line", "\t", -1)
    return rows.select("file", "sent", "comments", *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """Elements of a name, wherever they stand; attributes have an underscore in front."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def by_rules(records: DataFrame, rules: Mapping[str, str], where: str | None = None) -> DataFrame:
    """Records mapped by rules: name of an attribute or field, and a SQL expression over the record; ``where`` skips others."""
    rows = records.where(where) if where else records
    return rows.select(*(F.coalesce(F.expr(e).cast("string"), F.lit("")).alias(n) for n, e in rules.items()))


def utterances(spark: SparkSession, path: str) -> DataFrame:
    """Speech tiers (EAF): file, tier, speaker, start and end in milliseconds, text. An annotation that refers to another has its times."""
    name = F.col("_metadata.file_path").alias("file")
    slots = xml_records(spark, path, "TIME_SLOT", "_TIME_SLOT_ID string, _TIME_VALUE long").select(name, "_TIME_SLOT_ID", "_TIME_VALUE")
    aligned = "ALIGNABLE_ANNOTATION: struct<_ANNOTATION_ID: string, _TIME_SLOT_REF1: string, _TIME_SLOT_REF2: string, ANNOTATION_VALUE: string>"
    refers = "REF_ANNOTATION: struct<_ANNOTATION_ID: string, _ANNOTATION_REF: string, ANNOTATION_VALUE: string>"
    tiers = xml_records(spark, path, "TIER", f"_TIER_ID string, _PARTICIPANT string, ANNOTATION array<struct<{aligned}, {refers}>>")
    rows = tiers.select(name, F.col("_TIER_ID").alias("tier"), F.col("_PARTICIPANT").alias("speaker"), F.explode("ANNOTATION").alias("a"))
    at = lambda ref, as_: slots.select("file", F.col("_TIME_SLOT_ID").alias(ref), F.col("_TIME_VALUE").alias(as_))
    own = rows.where("a.ALIGNABLE_ANNOTATION IS NOT NULL").select("file", "tier", "speaker", "a.ALIGNABLE_ANNOTATION.*")
    own = own.join(at("_TIME_SLOT_REF1", "start"), ["file", "_TIME_SLOT_REF1"], "left").join(at("_TIME_SLOT_REF2", "end"), ["file", "_TIME_SLOT_REF2"], "left")
    shape = lambda df: df.select("file", "tier", "speaker", "start", "end", F.col("ANNOTATION_VALUE").alias("text"))
    out, known = shape(own), own.select("file", F.col("_ANNOTATION_ID").alias("_ANNOTATION_REF"), "start", "end")
    linked = rows.where("a.REF_ANNOTATION IS NOT NULL").select("file", "tier", "speaker", "a.REF_ANNOTATION.*")
    while not linked.isEmpty():  # a round for each tier that hangs on another
        met = linked.join(known, ["file", "_ANNOTATION_REF"])
        if met.isEmpty():
            return out.unionByName(shape(linked.withColumns({"start": F.lit(None).cast("long"), "end": F.lit(None).cast("long")})))
        out, linked = out.unionByName(shape(met)), linked.join(known, ["file", "_ANNOTATION_REF"], "left_anti")
        known = met.select("file", F.col("_ANNOTATION_ID").alias("_ANNOTATION_REF"), "start", "end")
    return out


def forum_csv(spark: SparkSession, path: str, columns: Sequence[str], separator: str = ",") -> DataFrame:
    """A forum dump whose head must be ``columns``; values may hold line ends. All are strings."""
    found = spark.read.option("header", True).option("sep", separator).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    if found.columns != list(columns):
        raise BadData(f"head is {found.columns}, not {list(columns)}")
    return found.na.fill("")


def forum_messages(rows: DataFrame, id_col: str, time_col: str, body_col: str, title_col: str | None = None) -> DataFrame:
    """Posts as texts: id, date and time attributes, and their cleaned content."""
    ts = F.col(time_col).try_cast("timestamp")
    clean = T.drop_soft_hyphens(F.regexp_replace(body_col, r"<[^<>]*>", " "))
    return rows.select(F.col(id_col).alias("text_id"), *(F.coalesce(e, F.lit("")).alias(n) for n, e in T.date_parts(ts).items()), *([F.col(title_col).alias("title")] if title_col else []), T.collapse_spaces(clean).alias("content"))


def json_articles(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Articles: an array of objects (or one) in each file, or with ``lines`` an object in each line; the schema says what is read."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def article_paragraphs(articles: DataFrame, keys: Sequence[str], content: str, kinds: Sequence[str] = ("text", "heading"), kind: str = "type", value: str = "text") -> DataFrame:
    """keys, para_no, kind, content: the items of an article's content that are of some kinds, without markup, in order; empty ones go."""
    clean = lambda c: T.collapse_spaces(F.translate(T.unescape(F.regexp_replace(c, r"<[^<>]*>", " ")), "\n\t\r", "   "))
    items = F.transform(F.filter(content, lambda x: x[kind].isin(list(kinds))), lambda x: F.struct(x[kind].alias("kind"), clean(x[value]).alias("content")))
    rows = articles.select(*keys, F.posexplode(F.filter(items, lambda x: F.coalesce(x["content"], F.lit("")) != "")).alias("i", "p"))
    return rows.select(*keys, (F.col("i") + 1).cast("long").alias("para_no"), "p.kind", "p.content")


def binary_records(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, content of files such as archives or sheets, for a function in ``mapInPandas``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


WARC = b"WARC/1.0\r\n"


def _warc_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Files cut where a record may begin: file, block (where the piece's split begins), id (in order within a block), piece."""
    rows = spark.read.option("lineSep", WARC.decode()).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("piece"))


def _warc_head(piece: bytes) -> tuple[dict[str, str], int, int]:
    """The fields of a record's head, where its body begins (-1: no end of the head), how long the body is (-1: not told)."""
    head, end, _ = piece.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n"))}
    size = fields.get("content-length", "")
    return fields, len(head) + 4 if end else -1, int(size) if size.isascii() and size.isdigit() else -1


def _warc_chain(pieces: DataFrame) -> DataFrame:
    """What a piece is that isn't a record by itself: ``kind`` part (of the record that began at ``first``), inside (looks whole, but lies within another record) or error.

    Records follow one another by the lengths in their heads, over the ends of splits, so a file's pieces are walked in
    order; only their sizes and what their heads say are gathered for that.
    """

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_warc_head(x)[1:] if x is not None else (-1, -1) for x in b.column(4).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), *columns], ["file", "block", "id", "length", "body", "size"])

    def walk(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["block", "id"])
        df["nr"] = df.groupby("block").cumcount()
        key, length, body, size = df[["block", "id", "nr"]].to_numpy(), df["length"].to_numpy(), df["body"].to_numpy(), df["size"].to_numpy()
        out, i, n = [(0, "before", 0, None)] if len(df) else [], 1, len(df)  # the first piece stands before the first record
        while i < n:
            if body[i] < 0 or size[i] < 0:
                out.append((i, "error", i, "no end of the head" if body[i] < 0 else "no content length"))
                i += 1
                continue
            end, have = i + 1, length[i] - body[i]
            while have < size[i] and end < n:
                have += len(WARC) + length[end]
                end += 1
            if have < size[i]:  # what follows may be whole
                out.append((i, "error", i, "the file ends within the record"))
                i += 1
                continue
            if end > i + 1:
                out += [(j, "part", i, None) for j in range(i, end)]
            i = end
        file = df["file"].iloc[0] if n else None
        rows = [(file, *key[j], kind, f"{key[first][0]}:{key[first][2]}", why) for j, kind, first, why in out]
        return pd.DataFrame(rows, columns=["file", "block", "id", "nr", "kind", "first", "error"])

    # Python gets heads only, with their end, and none where a piece has no end of a head
    head = F.when(F.contains("piece", F.lit("\r\n\r\n")), F.concat(F.substring_index("piece", "\r\n\r\n", 1), F.lit("\r\n\r\n"))).cast("binary")
    claims = pieces.select("file", "block", "id", F.octet_length("piece").cast("long").alias("length"), head.alias("head"))
    claims = claims.mapInArrow(sizes, "file string, block bigint, id bigint, length bigint, body bigint, size bigint")
    return claims.groupBy("file").applyInPandas(walk, "file string, block bigint, id bigint, nr bigint, kind string, first string, error string")


SLICE = 1 << 20  #: bytes of records that a task holds as Python objects


def _warc_parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["uri", "date", "body"])

    for b in batches:
        out: list[tuple] = []
        held = 0
        for value in b.column(0):
            x = value.as_py()
            fields, body, size = _warc_head(x)
            if fields.get("warc-type") == "response" and body >= 0 and 0 <= size <= len(x) - body:
                out.append((fields.get("warc-target-uri"), fields.get("warc-date"), x[body : body + size].partition(b"\r\n\r\n")[2].decode("utf-8", "replace")))
                held += size
            if held > SLICE:
                yield batch(out)
                out, held = [], 0
        yield batch(out)


def warc_responses(spark: SparkSession, path: str) -> DataFrame:
    """uri, date, body of the responses in uncompressed or gzipped crawls, wherever splits end.

    Most records are a piece each and are parsed where they were read. Records whose body holds what looks like a record's
    beginning are put together from their pieces, and nothing else is shuffled.
    """
    pieces = _warc_pieces(spark, path)
    chain = _warc_chain(pieces)
    key = ["file", "block", "id"]
    binary = F.col("piece").cast("binary").alias("piece")
    whole = pieces.join(chain.select(*key), key, "left_anti").select(binary)
    parts = pieces.select(*key, binary).join(chain.where("kind = 'part'").select(*key, "first"), key).groupBy("file", "first").agg(F.array_sort(F.collect_list(F.struct("block", "id", "piece"))).alias("p"))
    joined = parts.select(F.expr("aggregate(slice(p, 2, size(p)), p[0].piece, (a, x) -> concat(a, encode('WARC/1.0\r\n', 'UTF-8'), x.piece))").alias("piece"))
    return whole.union(joined).mapInArrow(_warc_parsed, "uri string, date string, body string")


def warc_errors(spark: SparkSession, path: str) -> DataFrame:
    """What can't be read: file, block and nr (where the record's piece is), error. The records around it are read."""
    return _warc_chain(_warc_pieces(spark, path)).where("kind = 'error'").select("file", "block", "nr", "error")


def tei_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row for each TEI file: file, title, author, date, lang, and paragraphs (n, kind, content) of its body in order.

    Paragraphs, heads and verse lines are what is kept; notes go, other markup inside is dropped, line and page breaks are blanks.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("x"))
    head = F.regexp_extract("x", r"(?s)<teiHeader\b.*?</teiHeader>", 0)
    plain = lambda c: T.collapse_spaces(F.translate(T.unescape(F.regexp_replace(c, r"<[^<>]*>", " ")), "\n\t\r", "   "))
    first = lambda tag, of: plain(F.regexp_extract(of, rf"(?s)<{tag}\b[^<>]*>(.*?)</{tag}>", 1))
    body = F.regexp_replace(F.regexp_extract("x", r"(?s)<body\b[^<>]*>(.*)</body>", 1), r"(?s)<note\b[^<>]*(?:/>|>.*?</note>)", "")
    stretch = r"(?s)(<(?:p|head|l)\b[^<>/]*>.*?</(?:p|head|l)>)"
    found = F.transform(F.regexp_extract_all(body, F.lit(stretch), F.lit(1)), lambda p: F.struct(F.regexp_extract(p, r"^<(p|head|l)", 1).alias("kind"), plain(p).alias("content")))
    kept = F.filter(found, lambda p: p["content"] != "")
    numbered = F.transform(kept, lambda p, i: F.struct((i + 1).cast("long").alias("n"), p["kind"].alias("kind"), p["content"].alias("content")))
    day = F.coalesce(F.nullif(F.regexp_extract(head, r'<date\b[^<>]*\bwhen="([^"]*)"', 1), F.lit("")), first("date", head))
    return whole.select("file", first("title", head).alias("title"), first("author", head).alias("author"), day.alias("date"), F.regexp_extract("x", r'<TEI\b[^<>]*\bxml:lang="([^"]*)"', 1).alias("lang"), numbered.alias("paragraphs"))


def alto_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scanned pages (ALTO XML): file, block, block_no, line_no, words, and the mean of their word confidences; hyphenated words are joined by their full content."""
    string = "struct<_CONTENT: string, _WC: double, _SUBS_TYPE: string, _SUBS_CONTENT: string>"
    schema = f"_ID string, TextLine array<struct<String: array<{string}>>>"
    blocks = xml_records(spark, path, "TextBlock", schema).select(F.col("_metadata.file_name").alias("file"), F.col("_ID").alias("block"), F.monotonically_increasing_id().alias("block_no"), F.posexplode("TextLine").alias("i", "l"))
    strings = F.filter(F.col("l.String"), lambda s: F.coalesce(s["_SUBS_TYPE"], F.lit("")) != "HypPart2")
    word = F.transform(strings, lambda s: F.when(s["_SUBS_TYPE"] == "HypPart1", F.coalesce(s["_SUBS_CONTENT"], s["_CONTENT"])).otherwise(s["_CONTENT"]))
    sure = F.aggregate(strings, F.lit(0.0), lambda a, s: a + F.coalesce(s["_WC"], F.lit(0.0)))
    return blocks.select("file", "block", "block_no", (F.col("i") + 1).alias("line_no"), F.filter(word, lambda w: w.isNotNull()).alias("words"), F.when(F.size(strings) > 0, sure / F.size(strings)).alias("confidence"))


def mets_files(spark: SparkSession, path: str) -> DataFrame:
    """file, id, use and href of the files that METS descriptions list."""
    rows = xml_records(spark, path, "fileGrp", "_USE string, _ID string, file array<struct<_ID: string, FLocat: struct<`_xlink:href`: string>>>")
    return rows.select(F.col("_metadata.file_name").alias("file"), F.coalesce("_USE", "_ID").alias("use"), F.explode("file").alias("f")).select("file", F.col("f._ID").alias("id"), "use", F.col("f.FLocat.`_xlink:href`").alias("href"))


def sparv_tokens(spark: SparkSession, path: str, attributes: Sequence[str]) -> DataFrame:
    """Annotated XML with a sentence a record: sent, tok_no, word, and attributes of tokens."""
    schema = "_id string, token array<struct<_VALUE: string" + "".join(f", `_{a}`: string" for a in attributes) + ">>"
    rows = xml_records(spark, path, "sentence", schema).select(F.col("_id").alias("sent"), F.posexplode("token").alias("i", "t"))
    return rows.select("sent", (F.col("i") + 1).alias("tok_no"), F.col("t._VALUE").alias("word"), *(F.coalesce(F.col(f"t._{a}"), F.lit("")).alias(a) for a in attributes))


def table_source(spark: SparkSession, url: str, table: str, partition_column: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1) -> DataFrame:
    """A table of a database by JDBC, read in parts by ranges of a column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts)
    return reader.load()
