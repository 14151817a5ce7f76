"""Frequencies, quantiles, sizes and other counts. All are aggregates that combine before their shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.operators.relation import running_sum
from spanloom.session import Scratch
from spanloom.sources.corpus import KEYS, Corpus, sentence_arrays

#: Classes of characters in line statistics.
CLASSES = {"w": r"[\p{L}\p{N}_]", "W": r"[^\p{L}\p{N}_]", "s": r"\s", "S": r"\S", "shy": r"\x{00AD}"}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1))


def frequencies(rows: DataFrame, value: str, keys: Sequence[str] = (), rank: bool = True) -> DataFrame:
    """Per value (and key): n, ipm (per million, two digits), rank (ties share the first). Only distinct values are ranked."""
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("__total"))
    joined = counted.join(totals, list(keys)) if keys else counted.crossJoin(F.broadcast(totals))  # one row
    out = joined.withColumn("ipm", F.round(F.col("n") * 1000000.0 / F.col("__total"), 2)).drop("__total")
    if not rank:
        return out
    # a frequency's rank follows from the distinct frequencies, which are few
    freqs = counted.groupBy(*keys, "n").agg(F.count("*").alias("__same"))
    above = F.coalesce(F.sum("__same").over(Window.partitionBy(*keys).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.join(freqs.withColumn("rank", above + 1).drop("__same"), [*keys, "n"]).select(*keys, value, "n", "ipm", "rank")


def nested_distinct(rows: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Per key: distinct values of (a), (a, b), (a, b, c)..., and rows. Each level is counted from the distinct values of the one below."""
    level = rows.groupBy(key, *attributes).agg(F.count("*").alias("__n"))
    level = Scratch(rows.sparkSession, "nested").write(level)
    counts = [level.groupBy(key).agg(F.sum("__n").alias("v")).withColumn("of", F.lit("n_tokens"))]
    for i in range(len(attributes), 0, -1):
        held = list(attributes[:i])
        level = level.select(key, *held).distinct()
        counts.append(level.na.drop(subset=held).groupBy(key).agg(F.count("*").alias("v")).withColumn("of", F.lit(f"n_{attributes[i - 1]}")))
    found = reduce(DataFrame.unionByName, counts).groupBy(key)
    return found.agg(*(F.coalesce(F.max(F.when(F.col("of") == n, F.col("v"))), F.lit(0)).alias(n) for n in [*(f"n_{a}" for a in attributes), "n_tokens"]))


def quantiles(rows: DataFrame, value: str, parts: int) -> DataFrame:
    """k, value for k from 0 to ``parts``: the least value at or below which there are k/parts of the rows, exactly, by whole numbers."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    total = rows.agg(F.count(value).alias("total"))  # one row
    running = running_sum(counted.select(F.col(value).alias("v"), "n"), [F.col("v")], F.col("n"), "cum").crossJoin(F.broadcast(total))
    ks = rows.sparkSession.range(parts + 1).select(F.col("id").alias("k"))
    return running.join(F.broadcast(ks), F.col("cum") * parts >= F.col("k") * F.col("total")).groupBy("k").agg(F.min("v").alias("value"))


def quantiles_by(rows: DataFrame, keys: Sequence[str], value: str, parts: int) -> DataFrame:
    """As ``quantiles``, by key: keys, k, value. One running sum over keys and values, so that a key's values needn't fit a task."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n")).withColumnRenamed(value, "__v")
    running = running_sum(counted, [F.col(k) for k in [*keys, "__v"]], F.col("n"), "cum")
    bounds = running.groupBy(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys))).agg(F.min(F.col("cum") - F.col("n")).alias("base"), F.max("cum").alias("top"))
    same = reduce(lambda a, b: a & b, (F.equal_null(F.col(k), F.col(f"__key{i}")) for i, k in enumerate(keys)))
    met = running.join(bounds, same).select(*keys, F.col("__v").alias("v"), (F.col("cum") - F.col("base")).alias("cum"), (F.col("top") - F.col("base")).alias("total"))
    ks = rows.sparkSession.range(parts + 1).select(F.col("id").alias("k"))
    return met.join(F.broadcast(ks), F.col("cum") * parts >= F.col("k") * F.col("total")).groupBy(*keys, "k").agg(F.min("v").alias("value"))


def element_sizes(corpus: Corpus, level: str, of: str = "token") -> DataFrame:
    """How many elements hold how many of what lies below: size, n. Elements without any are those that are not among the others, so nothing is joined."""
    keys = KEYS[level]
    if of == "token":  # sentences know their sizes
        sents = sentence_arrays(corpus) if corpus.arrays is not None else corpus.tokens.groupBy(*KEYS["sentence"]).agg(F.count("*").alias("n"))
        size = F.size("t") if corpus.arrays is not None else F.col("n")
        held = sents.select(size.alias("size")) if level == "sentence" else sents.groupBy(*keys).agg(F.sum(size).alias("size"))
    else:
        held = corpus.level(of).groupBy(*keys).agg(F.count("*").alias("size"))
    one, none = F.lit(1).alias("n"), F.lit(0).cast("long").alias("size")
    held = held.select(F.explode(F.array(F.struct(F.col("size").cast("long").alias("size"), one), F.struct(none, F.lit(-1).alias("n")))).alias("h")).select("h.*")
    return held.union(corpus.level(level).select(none, one)).groupBy("size").agg(F.sum("n").alias("n")).where("n <> 0")


def size_summary(histogram: DataFrame, parts: int = 4) -> DataFrame:
    """One row of a histogram (size, n): mean and the quantiles q0 to q<parts>."""
    w = Window.orderBy("size")
    running = histogram.withColumn("cum", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy()))
    return running.agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), *(F.min(F.when(F.col("cum") * parts >= k * F.col("total"), F.col("size"))).alias(f"q{k}") for k in range(parts + 1)))


def class_runs(text: Column, kind: str) -> dict[str, Column]:
    """How many characters of a class, how many runs of them, and the longest run."""
    pattern = CLASSES[kind]
    runs = F.regexp_extract_all(text, F.lit(f"({pattern}+)"), F.lit(1))
    return {f"{kind}_chars": F.length(F.array_join(runs, "")).cast("long"), f"{kind}_runs": F.size(runs).cast("long"), f"{kind}_max": F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)).cast("long")}


def character_frequencies(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.explode(F.split(text, "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count("*").alias("n"))


def attribute_inventory(corpus: Corpus) -> DataFrame:
    """level, attribute, n, n_set (values that look like sets), is_set (most do)."""
    parts = [corpus.level(level).select(F.lit(level).alias("level"), F.explode("attrs").alias("attribute", "v")) for level in ("text", "paragraph", "sentence")]
    rows = parts[0].union(parts[1]).union(parts[2])
    return rows.groupBy("level", "attribute").agg(F.count("*").alias("n"), F.count_if(F.rlike("v", F.lit(r"^[|].*[|]$|^[|]$"))).alias("n_set")).withColumn("is_set", F.col("n_set") * 2 > F.col("n"))


#: Elements of HTML that have no end tag.
VOID = "area base br col embed hr img input link meta param source track wbr".split()


def markup_tags(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, pos, name, kind (1 opens, -1 closes, 0 neither), attrs (names), in order."""
    tags = F.regexp_extract_all(text, F.lit(r"<(/?[A-Za-z][^<>]*)>"), F.lit(1))
    rows = rows.select(F.col(id_col).alias("id"), F.posexplode(tags).alias("pos", "tag"))
    name = F.lower(F.regexp_extract("tag", r"^/?([A-Za-z][A-Za-z0-9]*)", 1))
    kind = F.when(F.startswith("tag", F.lit("/")), -1).when(F.endswith("tag", F.lit("/")) | name.isin(VOID), 0).otherwise(1)
    return rows.select("id", "pos", name.alias("name"), kind.alias("kind"), F.regexp_extract_all("tag", F.lit(r'\s([A-Za-z][A-Za-z0-9-]*)='), F.lit(1)).alias("attrs"))


def markup_counts(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """By element: how many, and how many attributes they have."""
    tags = markup_tags(rows, id_col, text).where("kind >= 0")
    return tags.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.size("attrs")).alias("n_attrs"))


def markup_depth(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """By document: the deepest nesting, from a running sum of tags."""
    depth = F.sum("kind").over(Window.partitionBy("id").orderBy("pos"))
    return markup_tags(rows, id_col, text).withColumn("d", depth).groupBy("id").agg(F.max("d").alias("depth"))


def markup_values(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """name, attribute, value, n: how often each value of an attribute occurs in start tags."""
    tags = F.regexp_extract_all(text, F.lit(r"<([A-Za-z][^<>]*)>"), F.lit(1))
    rows = rows.select(F.explode(tags).alias("tag"))
    pairs = F.regexp_extract_all("tag", F.lit(r'\s([A-Za-z][A-Za-z0-9-]*="[^"]*")'), F.lit(1))
    found = rows.select(F.lower(F.regexp_extract("tag", r"^([A-Za-z][A-Za-z0-9]*)", 1)).alias("name"), F.explode(pairs).alias("p"))
    return found.select("name", F.substring_index("p", "=", 1).alias("attribute"), F.regexp_extract("p", r'="([^"]*)"', 1).alias("value")).groupBy("name", "attribute", "value").agg(F.count("*").alias("n"))


def _nested(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """Start tags and void ones: id, pos, name, kind, depth (that of the tag itself, from 1)."""
    depth = F.sum("kind").over(Window.partitionBy("id").orderBy("pos"))
    tags = markup_tags(rows, id_col, text).withColumn("depth", depth).where("kind >= 0")
    return tags.select("id", "pos", "name", "kind", F.when(F.col("kind") == 0, F.col("depth") + 1).otherwise(F.col("depth")).alias("depth"))


def markup_children(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """parent, name, n: elements by the one they are in (null: none), the last one that began a level above before them."""
    tags = _nested(rows, id_col, text)
    places = tags.where("kind = 1").select("id", "pos", F.col("depth").alias("level"), F.col("name").alias("parent"), F.lit(None).cast("string").alias("name"))
    children = tags.select("id", "pos", (F.col("depth") - 1).alias("level"), F.lit(None).cast("string").alias("parent"), "name")
    last = F.last("parent", ignorenulls=True).over(Window.partitionBy("id", "level").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return places.union(children).withColumn("parent", last).where("name IS NOT NULL").groupBy("parent", "name").agg(F.count("*").alias("n"))


def markup_nesting(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """name, nesting: how many elements of a name are open at once, at most."""
    tags = markup_tags(rows, id_col, text)
    open_ = F.sum("kind").over(Window.partitionBy("id", "name").orderBy("pos"))
    return tags.withColumn("d", F.when(F.col("kind") == 0, 1).otherwise(open_)).groupBy("name").agg(F.max("d").alias("nesting"))


def corpus_info(corpus: Corpus, date: str | None = None) -> DataFrame:
    """One row: texts, sentences, tokens, first and last date."""
    day = F.nullif(F.col("attrs")[date], F.lit("")) if date else F.lit(None).cast("string")
    return (
        corpus.texts.agg(F.count("*").alias("texts"), F.min(day).alias("firstdate"), F.max(day).alias("lastdate"))
        .crossJoin(corpus.sentences.agg(F.count("*").alias("sentences")))  # one row each
        .crossJoin(corpus.tokens.agg(F.count("*").alias("tokens")))
    )


def grouped_statistics(rows: DataFrame, keys: Sequence[str], sums: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Sums, counts and distinct counts over all combinations of the keys and their margins (null: all)."""
    return rows.cube(*keys).agg(F.count("*").alias("n"), *(F.sum(s).alias(f"sum_{s}") for s in sums), *(F.countDistinct(d).alias(f"n_{d}") for d in distinct))


def combine_records(rows: DataFrame, keys: Sequence[str], sets: Sequence[str], comment: str | None = None) -> DataFrame:
    """Records that agree in the keys become one with the union of their set values.

    With ``comment``, only those whose comments agree too; a record without one goes to the smallest comment of its keys.
    """
    if comment:
        least = rows.groupBy(*keys).agg(F.min(F.nullif(F.col(comment), F.lit(""))).alias("__least"))
        rows = rows.join(least, list(keys)).withColumn(comment, F.coalesce(F.nullif(F.col(comment), F.lit("")), "__least", F.lit(""))).drop("__least")
    return rows.groupBy(*keys, *([comment] if comment else [])).agg(*(F.array_sort(F.array_distinct(F.flatten(F.collect_set(s)))).alias(s) for s in sets))
