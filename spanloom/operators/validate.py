"""Checks of annotated text. Each rule is a filter that yields issues; a report is their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.functions.text import CHARACTER_KINDS
from spanloom.sources.corpus import KEYS, Corpus, gathered

#: The longest line and attribute value, in bytes.
MAX_LINE, MAX_VALUE = 65534, 4095


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, nr (rises within a file), value."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("nr"), "value")


def line_issues(lines: DataFrame) -> DataFrame:
    """lines: file, nr, value. Per issue: file, nr, kind, level (error or warning), issue."""
    v = F.col("value")
    tag, token = F.startswith(v, F.lit("<")), ~F.startswith(v, F.lit("<")) & (v != "")
    attrs = F.regexp_extract_all(v, F.lit(r'([\w.-]+)="[^"]*"'), F.lit(1))
    values = F.regexp_extract_all(v, F.lit(r'="([^"]*)"'), F.lit(1))
    start = F.rlike(v, F.lit(r"^<[\w.-]+"))
    value_of = lambda name: F.regexp_extract(v, rf'\s{name}="([^"]*)"', 1)
    has = lambda name: F.rlike(v, F.lit(rf'\s{name}="'))
    rules = [
        ("line", "error", "longer than the limit", F.octet_length(v) > MAX_LINE),
        ("line", "error", "not valid UTF-8", ~F.is_valid_utf8(v)),
        ("line", "warning", "empty", v == ""),
        ("line", "warning", "blanks only", (v != "") & (F.trim(v) == "")),
        ("character", "error", "control", F.rlike(v, F.lit(CHARACTER_KINDS["control"]))),
        ("character", "warning", "private use", F.rlike(v, F.lit(CHARACTER_KINDS["private"]))),
        ("character", "error", "noncharacter", F.rlike(v, F.lit(CHARACTER_KINDS["noncharacter"]))),
        ("character", "warning", "direction", F.rlike(v, F.lit(CHARACTER_KINDS["bidi"]))),
        ("character", "warning", "soft hyphen", F.rlike(v, F.lit(CHARACTER_KINDS["shy"]))),
        ("tag", "error", "malformed", tag & ~F.rlike(v, F.lit(r'^<(?:/[\w.-]+|[\w.-]+(?: [\w.-]+="[^"<>]*")*|!--.*--)>$'))),
        ("tag", "error", "attribute twice", start & (F.size(F.array_distinct(attrs)) < F.size(attrs))),
        ("tag", "warning", "value with outer blanks", start & F.exists(values, lambda x: F.trim(x) != x)),
        ("tag", "error", "value longer than the limit", start & F.exists(values, lambda x: F.octet_length(x) > MAX_VALUE)),
        ("tag", "warning", "date isn't eight digits", start & F.exists(F.array(*(has(n) & ~F.rlike(value_of(n), F.lit(r"^(?:[0-9]{8})?$")) for n in ("datefrom", "dateto"))), lambda x: x)),
        ("tag", "warning", "time isn't six digits", start & F.exists(F.array(*(has(n) & ~F.rlike(value_of(n), F.lit(r"^(?:[0-9]{6})?$")) for n in ("timefrom", "timeto"))), lambda x: x)),
        ("token", "error", "bare <", token & F.contains(v, F.lit("<"))),
        ("token", "error", "bare &", F.rlike(v, F.lit(r"&(?!(?:lt|gt|amp|quot|apos);)"))),
        ("token", "warning", "empty field", token & F.rlike(v, F.lit(r"^\t|\t\t|\t$"))),
    ]
    issues = F.filter(F.array(*(F.when(c, F.struct(F.lit(k).alias("kind"), F.lit(level).alias("level"), F.lit(i).alias("issue"))) for k, level, i, c in rules)), lambda x: x.isNotNull())
    return lines.select("file", "nr", F.explode(issues).alias("i")).select("file", "nr", "i.*")


def nesting_issues(lines: DataFrame) -> DataFrame:
    """End tags without start, elements left open, elements in themselves: by a running depth for each element of a file."""
    tags = lines.where(F.rlike("value", F.lit(r"^</?[\w.-]+"))).select("file", "nr", F.regexp_extract("value", r"^</?([\w.-]+)", 1).alias("name"), F.when(F.startswith("value", F.lit("</")), -1).otherwise(1).alias("d"))
    depth = tags.withColumn("depth", F.sum("d").over(Window.partitionBy("file", "name").orderBy("nr")))
    end = depth.groupBy("file", "name").agg(F.max("nr").alias("nr"), F.sum("d").alias("depth")).where("depth > 0")
    shape = lambda df, issue: df.select("file", "nr", F.lit("nesting").alias("kind"), F.lit("error").alias("level"), F.lit(issue).alias("issue"))
    parts = [shape(depth.where("depth < 0"), "end without start"), shape(depth.where("d = 1 AND depth > 1"), "element in itself"), shape(end, "never ended")]
    return reduce(DataFrame.unionByName, parts)


def field_issues(lines: DataFrame) -> DataFrame:
    """Tokens of a file with another number of fields than most of its tokens."""
    tokens = lines.where("value <> '' AND NOT startswith(value, '<')").select("file", "nr", F.size(F.split("value", "\t", -1)).alias("k"))
    usual = tokens.groupBy("file", "k").count().groupBy("file").agg(F.max(F.struct("count", -F.col("k"))).alias("m")).select("file", (-F.col("m.col2")).alias("usual"))
    return tokens.join(usual, "file").where("k <> usual").select("file", "nr", F.lit("token").alias("kind"), F.lit("error").alias("level"), F.lit("another number of fields").alias("issue"))


def issue_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("kind", "level", "issue").agg(F.count("*").alias("n"), F.min("nr").alias("first"))


def tree_issues(tokens: DataFrame | Corpus, ref: str, head: str, several_roots: bool = False) -> DataFrame:
    """Per sentence with a dependency tree that isn't one: keys, issue.

    Heads of a sentence are one array; from each token, heads are followed by doubling, as
    often as the sentence's size asks for. What hasn't reached the root by then is on a cycle.
    """
    keys = KEYS["sentence"]
    heads = gathered(tokens, [ref, head]).select(*keys, F.array_sort(F.transform("t", lambda x: F.struct(x[ref].cast("int").alias("r"), x[head].cast("int").alias("h")))).alias("t"))
    # through a row of its own, so that what makes the arrays isn't merged into each expression that reads them
    both = F.struct(F.transform("t", lambda x: x["r"]).alias("r"), F.transform("t", lambda x: F.coalesce(x["h"], F.lit(-1))).alias("h"))
    heads = heads.select(*keys, F.inline(F.array(both)))
    n = F.size("h")
    sequential = F.col("r") == F.sequence(F.lit(1), n)
    in_range = F.forall("h", lambda x: (x >= 0) & (x <= F.size("h")))
    roots = F.size(F.filter("h", lambda x: x == 0))
    rows = heads.withColumn("ok", sequential & in_range).withColumn("j", F.when(F.col("ok"), F.col("h")).otherwise(F.array().cast("array<int>")))
    doublings = F.sequence(F.lit(1), F.ceil(F.log2(n)).cast("int") + 1)  # a fold, as so many projections would be merged into one huge expression
    rows = rows.withColumn("j", F.aggregate(doublings, F.col("j"), lambda acc, _: F.transform(acc, lambda x: F.when(x == 0, 0).otherwise(F.get(acc, x - 1)))))
    issue = F.when(~sequential, "ids aren't 1 to n").when(~in_range, "head out of range").when(roots == 0, "no root").when(F.lit(not several_roots) & (roots > 1), "several roots").when(F.exists("j", lambda x: x != 0), "cycle")
    return rows.select(*keys, issue.alias("issue")).where("issue IS NOT NULL")


def character_issues(rows: DataFrame, id_col: str, text: str, kind: str) -> DataFrame:
    """id, code (hex), n, first: how many characters of a kind a text has, by character, and where (from 1) the first stands."""
    found = F.regexp_extract_all(text, F.lit(f"({CHARACTER_KINDS[kind]})"), F.lit(1))
    own = rows.select(F.col(id_col).alias("id"), F.col(text).alias("text"), found.alias("found")).withColumn("ch", F.explode(F.array_distinct("found")))
    own = own.select("id", "ch", F.expr("size(filter(found, x -> x = ch))").alias("n"), F.expr("instr(text, ch)").alias("first"))
    return own.groupBy("id", "ch").agg(F.sum("n").alias("n"), F.min("first").alias("first")).select("id", F.hex(F.encode("ch", "UTF-16BE")).alias("code"), "n", "first")


def count_check(parts: DataFrame, column: str, expected: int) -> DataFrame:
    """One row: the sum of a column, what was expected, and whether they agree."""
    return parts.agg(F.coalesce(F.sum(column), F.lit(0)).alias("found")).select("found", F.lit(expected).alias("expected"), (F.col("found") == expected).alias("agree"))
