"""Tables made from a corpus: word pictures, lemma and name indexes, time spans, sentence lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.functions import text as T
from spanloom.session import Scratch
from spanloom.sources.corpus import KEYS


def dependency_pairs(tokens: DataFrame, keys: Sequence[str], ref: str, head: str, value: str, rel: str) -> DataFrame:
    """Tokens with their head in the sentence: keys, head, rel, dep. A sentence is one array in which heads are looked up, by place where ids run from 1."""
    item = F.struct(F.col(ref).cast("long").alias("r"), F.col(head).cast("long").alias("h"), F.col(value).alias("v"), F.col(rel).alias("rel"))
    return pairs_within(tokens.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("t")), keys)


def pairs_within(sents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``dependency_pairs``, of sentences that are arrays ``t`` of (r: a token's id, h: its head's, v: value, rel) already."""
    by_place = lambda x: F.get(F.col("t"), (x["h"] - 1).cast("int"))
    found = lambda x: F.when(by_place(x)["r"] == x["h"], by_place(x)).otherwise(F.get(F.filter("t", lambda y: y["r"] == x["h"]), F.lit(0)))
    pairs = F.filter(F.transform("t", lambda x: F.struct(found(x).alias("up"), x["rel"].alias("rel"), x["v"].alias("dep"))), lambda p: p["up"].isNotNull())
    return sents.select(*keys, F.explode(pairs).alias("p")).select(*keys, F.col("p.up.v").alias("head"), F.col("p.rel").alias("rel"), F.col("p.dep").alias("dep"))


def word_picture(pairs: DataFrame, few: int = 100_000) -> DataFrame:
    """head, rel, dep with freq and the marginals freq_rel, freq_head_rel, freq_rel_dep.

    Triples are written once, and marginals are aggregates of them, so no key gathers its rows in one task. There are few
    relations, so their sums are broadcast; should there be more than ``few``, they are joined.
    """
    triples = Scratch(pairs.sparkSession, "picture").write(pairs.groupBy("head", "rel", "dep").agg(F.count("*").alias("freq")))
    by_rel = triples.groupBy("rel").agg(F.sum("freq").alias("freq_rel"))
    by_rel = F.broadcast(by_rel) if by_rel.limit(few + 1).count() <= few else by_rel
    by_head = triples.groupBy("head", "rel").agg(F.sum("freq").alias("freq_head_rel"))
    by_dep = triples.groupBy("rel", "dep").agg(F.sum("freq").alias("freq_rel_dep"))
    return triples.join(by_rel, "rel").join(by_head, ["head", "rel"]).join(by_dep, ["rel", "dep"]).select("head", "rel", "dep", "freq", "freq_rel", "freq_head_rel", "freq_rel_dep")


def picture_sentences(pairs: DataFrame, keys: Sequence[str], most: int = 1000) -> DataFrame:
    """head, rel, dep and the first sentences (by key) that show the pair, at most ``most``: an index of examples."""
    # equal rows have one rank, so that only what is kept is made distinct, and tasks pass on the first sentences only
    ranked = pairs.withColumn("nr", F.dense_rank().over(Window.partitionBy("head", "rel", "dep").orderBy(*keys)))
    return ranked.where(F.col("nr") <= most).select("head", "rel", "dep", *keys).distinct()


def lemgram_index(rows: DataFrame, lemgrams: Column, prefixes: Column, suffixes: Column) -> DataFrame:
    """Set fields counted by role: lemgram, freq, freq_prefix, freq_suffix. Compounds (with a number) are left out."""

    def role(k: int, values: Column) -> Column:
        return F.transform(T.set_items(values), lambda v: F.struct(F.lit(k).alias("k"), v.alias("lemgram")))

    parts = F.array(*(role(k, c) for k, c in enumerate((lemgrams, prefixes, suffixes))))
    flat = rows.select(F.explode(F.flatten(parts)).alias("p")).select("p.*").where(~F.rlike("lemgram", F.lit(r":[0-9]+$")))
    return flat.groupBy("lemgram").agg(*(F.count_if(F.col("k") == i).alias(n) for i, n in enumerate(("freq", "freq_prefix", "freq_suffix"))))


def time_data(rows: DataFrame, start: Column, end: Column, tokens: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Tokens by span of time: keys, datefrom, dateto, tokens."""
    return rows.groupBy(*keys, start.alias("datefrom"), end.alias("dateto")).agg(F.sum(tokens).alias("tokens"))


def coarser_time_data(spans: DataFrame, length: int, keys: Sequence[str] = ()) -> DataFrame:
    """Spans at the granularity of the first ``length`` digits (4, 6, 8, 10, 12 or 14), filled up to their first and last instants."""
    cut = lambda c: F.substring(c, 1, length)
    return spans.groupBy(*keys, T.first_instant(cut("datefrom")).alias("datefrom"), T.last_instant(cut("dateto")).alias("dateto")).agg(F.sum("tokens").alias("tokens"))


def time_data_gap(spans: DataFrame, tokens: int) -> DataFrame:
    """One row: what the spans hold, what the corpus holds, and whether they agree."""
    return spans.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("in_spans")).select("in_spans", F.lit(tokens).alias("in_corpus"), (F.col("in_spans") == tokens).alias("agree"))


def runs(rows: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Maximal runs of equal values in order: keys, value, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    change = (~F.equal_null(F.col(value), F.lag(value).over(w)) | F.lag(order).over(w).isNull()).cast("long")
    marked = rows.withColumn("__run", F.sum(change).over(w))
    return marked.groupBy(*keys, "__run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("__run")


def name_index(tokens: DataFrame, tag: str, base: str, word: str, cased: bool = True) -> DataFrame:
    """With ``cased``, the last word's base form takes the case of its word. Names are maximal runs of tokens of a sentence with one name tag (``_`` or empty: none): name, cat, text_id, freq."""
    named = tokens.withColumn("__tag", F.when(F.col(tag).isin("_", "O", ""), None).otherwise(F.regexp_replace(tag, r"-[BIEFS]$|^[BIES]-", "")))
    begins = F.rlike(F.coalesce(tag, F.lit("")), F.lit(r"-[BF]$|^[BS]-"))
    w = Window.partitionBy(*KEYS["sentence"]).orderBy("tok_no")
    change = (begins | ~F.equal_null(F.col("__tag"), F.lag("__tag").over(w))).cast("long")
    marked = named.withColumn("__run", F.sum(change).over(w)).where("__tag IS NOT NULL")
    item = F.struct("tok_no", F.col(word).alias("w"), F.col(base).alias("b"))
    names = marked.groupBy(*KEYS["sentence"], "__run", "__tag").agg(F.array_sort(F.collect_list(item)).alias("t"))
    last = F.element_at("t", -1)
    lead = F.transform(F.slice("t", 1, F.size("t") - 1), lambda x: x["w"])
    name = F.concat_ws(" ", lead, T.name_case(last["b"], last["w"]) if cased else last["b"])
    return names.select("text_id", name.alias("name"), F.col("__tag").alias("cat")).groupBy("name", "cat", "text_id").agg(F.count("*").alias("freq"))


def sentence_list(tokens: DataFrame) -> DataFrame:
    """Per sentence its first and last token by the running number within the text: a running sum over sentences, so no text's tokens are sorted."""
    sizes = tokens.groupBy(*KEYS["sentence"]).agg(F.count("*").alias("__n"))
    end = F.sum("__n").over(Window.partitionBy("text_id").orderBy("para_no", "sent_no"))
    return sizes.withColumn("end", end).select(*KEYS["sentence"], (F.col("end") - F.col("__n") + 1).alias("start"), "end")


def interpolate_time(rows: DataFrame, keys: Sequence[str], order: str, time: str, undated: Column) -> DataFrame:
    """Undated rows get the middle of the dated neighbours before and after them, or the one there is. ``time`` is a number."""
    known = F.when(~undated, F.col(time))
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    middle = F.coalesce(F.floor((before + after) / 2), before, after)
    return rows.withColumn("filled", F.when(undated, middle).otherwise(F.col(time)))


def tag_offsets(tokens: DataFrame, tags: DataFrame, keys: Sequence[str], order: str, word: str, offset: str) -> DataFrame:
    """Tags by their character offset (blanks not counted) meet the token that covers it: a range join within each text, as running lengths that are compared in one ordered pass."""
    w = Window.partitionBy(*keys).orderBy(order)
    length = F.length(word)
    spans = tokens.select(*keys, F.col(order).alias("o"), (F.sum(length).over(w) - length).alias("at"), F.lit(None).cast("long").alias("tag_at"))
    marks = tags.select(*keys, F.lit(None).cast(dict(tokens.dtypes)[order]).alias("o"), F.col(offset).cast("long").alias("at"), F.col(offset).cast("long").alias("tag_at"))
    ahead = Window.partitionBy(*keys).orderBy("at", F.col("tag_at").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = spans.select(*keys, "o", "at", "tag_at", F.col("at").alias("s")).unionByName(marks.withColumn("s", F.lit(None).cast("long")))
    found = found.withColumn("token", F.last("o", ignorenulls=True).over(ahead)).withColumn("start", F.last("s", ignorenulls=True).over(ahead))
    return found.where("tag_at IS NOT NULL").select(*keys, F.col("tag_at").alias(offset), F.col("token").alias(order), (F.col("tag_at") == F.col("start")).alias("at_start"))


def keep_index_sorted(df: DataFrame, path: str, by: Sequence[str], parts: int | None = None) -> None:
    """A product written in range order of its keys, so that a lookup reads few files."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *by).sortWithinPartitions(*by).write.mode("errorifexists").parquet(path)
