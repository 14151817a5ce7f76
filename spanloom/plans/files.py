"""Queries that write tables in a format, in the shared folder, and read them again."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import elements, index, products
from spanloom.operators.relation import Relation
from spanloom.plans.catalogue import _TOKENS, _corpus, query
from spanloom.session import Scratch, table
from spanloom.sources import corpus as C
from spanloom.sources import formats, tsv
from spanloom.stages import Stages


def _folder(spark, name):
    return Scratch(spark, name).root


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def tsv_relation(spark, sf_dir):
    path = _folder(spark, "tsv")
    tsv.write_relation(Relation(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")), path)
    return tsv.read_parts(spark, path).df


@query("SELECT DISTINCT CAST(o_orderpriority AS VARCHAR) AS priority, CAST(o_orderstatus AS VARCHAR) AS v2 FROM orders")
def tsv_without_head(spark, sf_dir):
    """Lines without a head, of which many repeat."""
    path = _folder(spark, "lines")
    table(spark, sf_dir, "orders").select(F.concat_ws("\t", "o_orderpriority", "o_orderstatus")).write.text(path)
    return tsv.relation_from(spark, path, {"v1": "priority"}).df


_DENSE = f"""WITH {_TOKENS}, p AS (SELECT text_id, para_no, row_number() OVER (PARTITION BY text_id ORDER BY para_no) AS p FROM paras), s AS (SELECT text_id, para_no, sent_no, row_number() OVER (PARTITION BY text_id, para_no ORDER BY sent_no) AS s FROM sents)
 SELECT CAST(text_id AS VARCHAR) AS key, p AS para_no, s AS sent_no, tok_no, word FROM tokens JOIN p USING (text_id, para_no) JOIN s USING (text_id, para_no, sent_no)"""


@query(_DENSE)
def vertical_round_trip(spark, sf_dir):
    """Tokens of texts that were written as vertical text and read again; elements are numbered anew."""
    path = _folder(spark, "vertical")
    docs = table(spark, sf_dir, "documents").withColumn("key", F.col("doc_id").cast("string"))
    C.write_vertical(C.from_texts(docs, "doc_id", "text", ["key", "source"]), path, compression="gzip")
    return C.read_vertical(spark, path, ["word"], of_text=["key"]).tokens.select("key", "para_no", "sent_no", "tok_no", "word")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def vertical_by_attribute(spark, sf_dir):
    """A folder for each language."""
    path = _folder(spark, "folders")
    C.write_vertical(_corpus(spark, sf_dir), path, partition_by="lang")
    found = spark.read.option("lineSep", "</text>\n").text(path).where(F.contains("value", F.lit("<text ")))
    return found.groupBy("lang").agg(F.count("*").alias("n"))


@query(f"WITH {_TOKENS} SELECT word AS form, lower(word) AS lemma, count(*) AS n FROM tokens GROUP BY 1, 2")
def conll_round_trip(spark, sf_dir):
    path = _folder(spark, "conll")
    line = lambda x, i: F.concat_ws("\t", (i + 1).cast("string"), x["word"], F.lower(x["word"]))
    _corpus(spark, sf_dir).arrays.select(F.array_join(F.transform("t", line), "\n").alias("value")).select(F.concat(F.lit("# sent\n"), "value")).write.option("lineSep", "\n\n").text(path)
    return formats.conll(spark, path, ["id", "form", "lemma"]).groupBy("form", "lemma").agg(F.count("*").alias("n"))


@query("SELECT item_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || chr(10) AS content FROM benchmark")
def plain_text_files(spark, sf_dir):
    """A file for each text."""
    path = _folder(spark, "plain")
    table(spark, sf_dir, "benchmark").select("item_id", "text").repartition("item_id").write.partitionBy("item_id").text(path)
    found = formats.plain_texts(spark, path)
    return found.select(F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("long").alias("item_id"), "content")


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations")
def forum_csv(spark, sf_dir):
    path = _folder(spark, "csv")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return formats.forum_csv(spark, path, ["conv_id", "turn", "role", "text"])


@query("SELECT event_id AS text_id, strftime(ts, '%Y%m%d') AS datefrom, strftime(ts, '%Y%m%d') AS dateto, strftime(ts, '%H%M%S') AS timefrom, strftime(ts, '%H%M%S') AS timeto, event_type AS title, 'a ' || event_type || ' event' AS content FROM events")
def forum_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("time"), "event_type", F.concat(F.lit("<p>a  "), "event_type", F.lit("</p> <b>event</b>")).alias("body"))
    return formats.forum_messages(rows, "event_id", "time", "body", "event_type").select("text_id", "datefrom", "dateto", "timefrom", "timeto", "title", "content")


@query("SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS para_no, role AS kind, regexp_replace(trim(regexp_replace(text, '[\n\t\r]', ' ', 'g'), ' '), ' +', ' ', 'g') AS content FROM conversations WHERE role IN ('user', 'assistant') AND trim(regexp_replace(text, '[\n\t\r]', ' ', 'g'), ' ') <> ''")
def json_articles(spark, sf_dir):
    """Conversations as articles whose content is a list of parts of several kinds."""
    path = _folder(spark, "json")
    part = F.struct("turn", F.col("role").alias("type"), "text")
    table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("content")).write.json(path)
    found = formats.json_articles(spark, path, "conv_id long, content array<struct<type: string, text: string>>", lines=True)
    return formats.article_paragraphs(found, ["conv_id"], "content", ["user", "assistant"])


@query("SELECT lower(n_name) AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation WHERE n_regionkey > 1")
def xml_by_rules(spark, sf_dir):
    path = _folder(spark, "xml")
    table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").alias("_region")).write.format("xml").option("rootTag", "nations").option("rowTag", "nation").save(path)
    found = formats.xml_records(spark, path, "nation", "n_name string, _region long")
    return formats.by_rules(found, {"name": "lower(n_name)", "region": "_region"}, "_region > 1")


def _crawl(spark, sf_dir, compression):
    """Pages as a crawl; their bodies hold what looks like the beginning of a record, and a whole record."""
    path = _folder(spark, "warc")
    pages = table(spark, sf_dir, "pages").where("url IS NOT NULL AND html IS NOT NULL")
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\n\r\n\r\n"
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), "html", F.lit(inner), F.lit("WARC/1.0\r\nno record"))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Target-URI: "), "url", F.lit("\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit("\r\n\r\n"))
    info = F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    lines = pages.select("url", "html", body.alias("body")).select(F.concat(info, head, "body").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
    return formats.warc_responses(spark, path).select("uri", F.md5("body").alias("body"))


_CRAWL = "SELECT url AS uri, md5(html || replace('WARC/1.0|WARC-Type: response|Content-Length: 4||||WARC/1.0|no record', '|', chr(13) || chr(10))) AS body FROM pages WHERE url IS NOT NULL AND html IS NOT NULL"


@query(_CRAWL)
def warc_responses(spark, sf_dir):
    return _crawl(spark, sf_dir, "gzip")


@query(_CRAWL)
def warc_in_splits(spark, sf_dir):
    """Without compression, so that files are read in splits that end within records."""
    return _crawl(spark, sf_dir, "none")


@query("""WITH RECURSIVE d AS (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, coalesce(length(text), 0) AS n, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
 w AS (SELECT r, path, n AS held, CAST(1 AS BIGINT) AS part_no FROM d WHERE r = 1 UNION ALL SELECT d.r, d.path, CASE WHEN w.held + d.n > 30000 THEN d.n ELSE w.held + d.n END, CASE WHEN w.held + d.n > 30000 THEN w.part_no + 1 ELSE w.part_no END FROM w JOIN d ON d.r = w.r + 1)
 SELECT path, part_no FROM w""")
def pack_files(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("path"), F.col("text").alias("content"))
    return elements.pack_files(files, 30_000).select("path", "part_no")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def index_round_trip(spark, sf_dir):
    """A product in range order of its keys."""
    path = _folder(spark, "index")
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    products.keep_index_sorted(counted, path, ["user_id", "event_type"])
    return spark.read.parquet(path)


_INDEXED = f"""{_TOKENS}, freq AS (SELECT word, count(*) AS n FROM tokens GROUP BY 1), top AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS r FROM freq QUALIFY r <= 4)"""


def _index(spark, sf_dir):
    """An index of words and of their first letters' classes, and the four most frequent words."""
    path = _folder(spark, "index")
    shape = lambda x: F.when(F.rlike(x["word"], F.lit("^[A-Z]")), "capital").otherwise("other")
    corpus = _corpus(spark, sf_dir)
    corpus = C.of_arrays(corpus, corpus.arrays.select(*C.KEYS["sentence"], F.transform("t", lambda x: F.struct(x["word"], shape(x).alias("shape"))).alias("t")))
    index.build(corpus, path, ["word", "shape"])
    top = index.lexicon(spark, path, "word").orderBy(F.desc("freq"), "value").limit(4)
    return path, [r["value"] for r in top.collect()]


@query(f"""WITH {_INDEXED}
 SELECT CAST(a.text_id AS VARCHAR) AS text_id, a.para_no, a.sent_no, a.tok_no AS first, b.tok_no AS last FROM tokens a JOIN tokens b ON a.text_id = b.text_id AND a.para_no = b.para_no AND a.sent_no = b.sent_no AND b.tok_no BETWEEN a.tok_no + 1 AND a.tok_no + 3
 WHERE a.word IN (SELECT word FROM top WHERE r <= 2) AND b.word IN (SELECT word FROM top WHERE r > 2)""")
def index_sequences(spark, sf_dir):
    """One of the two most frequent words, at most two tokens, and one of the next two."""
    path, top = _index(spark, sf_dir)
    return index.find(spark, path, [index.Step({"word": top[:2]}), index.Step({"word": top[2:]}, (0, 2))])


@query(f"""WITH {_INDEXED}
 SELECT CAST(a.text_id AS VARCHAR) AS text_id, a.para_no, a.sent_no, a.tok_no AS first, c.tok_no AS last FROM tokens a JOIN tokens b ON a.text_id = b.text_id AND a.para_no = b.para_no AND a.sent_no = b.sent_no AND b.tok_no = a.tok_no + 1
 JOIN tokens c ON a.text_id = c.text_id AND a.para_no = c.para_no AND a.sent_no = c.sent_no AND c.tok_no = a.tok_no + 2
 WHERE regexp_matches(a.word, '^[A-Z]') AND length(a.word) > 5 AND b.word IN (SELECT word FROM top) AND NOT regexp_matches(c.word, '^[A-Z]') AND regexp_matches(c.word, 'en$')""")
def index_conditions(spark, sf_dir):
    """A long word with a capital, a frequent word, and a word in lower case that ends in -en."""
    path, top = _index(spark, sf_dir)
    return index.find(spark, path, [index.Step({"shape": "capital", "word": index.Where("length(value) > 5")}), index.Step({"word": top}), index.Step({"shape": "other", "word": index.Where("value RLIKE 'en$'")})])


@query(f"WITH {_INDEXED} SELECT word AS value, n AS freq FROM freq")
def index_lexicon(spark, sf_dir):
    return index.lexicon(spark, _index(spark, sf_dir)[0], "word")


@query("SELECT lang, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars, 'words,sizes' AS skipped FROM documents WHERE text IS NOT NULL GROUP BY lang")
def resumed_stages(spark, sf_dir):
    """Two stages, run, and run again: the second time both are read."""
    root = _folder(spark, "stages")

    def job():
        stages = Stages(spark, root)
        kept = stages.run("words", lambda: table(spark, sf_dir, "documents").where("text IS NOT NULL").select("lang", F.length("text").alias("n")), [f"{sf_dir}/documents.parquet"])
        return stages, stages.run("sizes", lambda: kept.groupBy("lang").agg(F.count("*").alias("texts"), F.sum("n").alias("chars")), [kept])

    job()
    stages, sizes = job()
    return sizes.withColumn("skipped", F.lit(",".join(stages.skipped)))
