"""Groups of spelling variants: words one edit apart, found by a frontier that walks a trie of all words in joins.

The trie is a table of edges, made level by level from the words that still share their node with others: a node is the
prefix it stands for, and an edge tells its letter, how many words lie below it, which letters follow it, and the word
where there is but one (from there on no edges are made: what is left of the word is compared at once). States are (word,
position, node, edits). At each level the states at this depth meet their nodes' edges:

* without an edit so far, a word is at its own prefix. It goes on along its own letter, or with one edit: along a larger
  letter (a replacement, position + 1), or along the letter after the next (its next letter left out, position + 2);
* with one edit, it goes along its own next letter only.

A state that ends at a word has found a neighbour. Each pair of neighbours is found once, from the smaller of two words of
equal length or from the longer one, and turned round afterwards. A letter is left out at the end of a run of equal letters
only, so no pair is found twice. There are as many levels as the longest prefix that two words share has letters.

States and nodes are written level by level. The edges of a level are sent to all tasks while they are at most ``FEW``,
which is counted; beyond, states are joined by node, and those of nodes with many states are dealt over tasks.

``word_counts`` makes the words from texts; ``neighbours`` and ``forms`` take any table of words and counts.

Defined results: null texts have no words; a null id counts as an empty text in the checksum; repeated rows count each;
texts and words are taken whole; no words give an empty table; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPO = 199  #: a run loses a letter if this divides its checksum
LENGTH, OFTEN, RATIO = 6, 5, 5  #: least letters and occurrences of a word; how much more frequent its form is
FEW = 100_000  #: edges of a level that are broadcast
HELD = 2000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = TYPO, length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """word, n. ``typo``: None leaves all runs as they are."""
    runs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(docs[text_col].cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= length).select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if typo:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        runs = runs.select("word", h.alias("h")).select("word", "h", (F.col("h") % F.length("word")).cast("int").alias("at"))
        runs = runs.select(F.expr(f"CASE WHEN h % {typo} = 0 THEN substr(word, 1, at) || substr(word, at + 2) ELSE word END").alias("word"))
    return runs.groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= length) & (F.col("n") >= often))


def _edges(live: DataFrame, depth: int) -> DataFrame:
    """live: word, n, node. Per node of this depth its edges: letter (empty where a word ends), words below, the only word, letters that follow."""
    letter = F.substring("word", depth + 1, 1)
    edges = live.groupBy("node", letter.alias("c")).agg(F.count("*").alias("m"), F.min(F.struct("word", "n")).alias("w"), F.collect_set(F.substring("word", depth + 2, 1)).alias("next"))
    return edges.groupBy("node").agg(F.collect_list(F.struct("c", "m", F.when(F.col("m") == 1, F.col("w")).alias("w"), "next")).alias("edges"))


def _moves(depth: int) -> Column:
    """What a state makes of its node's edges: (edits, pos, edge)."""
    at = lambda k: F.substring(F.col("word"), F.col("pos") + k, F.lit(1))
    inside = F.col("pos") < F.length("word")
    fits = lambda e, after: (e["m"] == 1) | F.array_contains(e["next"], after)
    step = lambda edits, by, which: F.transform(F.filter("edges", which), lambda e: F.struct(F.lit(edits).alias("edits"), (F.col("pos") + by).alias("pos"), e.alias("e")))
    own = step(0, 1, lambda e: inside & (e["c"] == at(1)) & (e["m"] > 1))
    replaced = step(1, 1, lambda e: inside & (e["c"] > at(1)) & fits(e, at(2)))
    left_out = step(1, 2, lambda e: inside & (at(1) != at(2)) & (e["c"] == at(2)) & fits(e, at(3)))
    onward = step(1, 1, lambda e: (e["c"] == at(1)) & fits(e, at(2)))
    return F.when(F.col("edits") == 0, F.concat(own, replaced, left_out)).otherwise(onward)


STATE = ["word", "n", "pos", "node", "edits"]


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """words: word, n (distinct, written). Each pair of words one edit apart, once: a, na, b, nb."""
    found, depth = [], 0
    states = words.select("word", "n", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits"))
    while True:
        live = states.where("edits = 0")
        nodes = scratch.write(_edges(live, depth))
        if (nodes.agg(F.sum(F.size("edges"))).first()[0] or 0) <= FEW:
            met = states.repartition("word").join(F.broadcast(nodes), "node")
        else:
            counts = states.groupBy("node").agg(F.count("*").alias("states"))
            met = hot_join(states, scratch.write(nodes.join(counts, "node")), ["node"], "states", HELD)
        moved = met.select("word", "n", "node", F.explode(_moves(depth)).alias("s")).select("word", "n", "s.pos", "node", "s.edits", "s.e")
        ends = (F.col("edits") == 1) & F.col("e.w").isNotNull()
        # what an edge leads to: its only word, whose rest has to be that of this word, or a node
        same = F.expr(f"substr(word, pos + 1) = substr(e.w.word, {depth + 2})")
        moved = moved.where(~ends | same).select("word", "n", "pos", F.when(~ends, F.concat("node", "e.c")).alias("node"), "edits", F.when(ends, F.col("e.w")).alias("other"))
        moved = scratch.write(moved)
        found.append(moved.where("other IS NOT NULL").select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("other.word").alias("b"), F.col("other.n").alias("nb")))
        states, depth = moved.where("other IS NULL").select(*STATE), depth + 1
        if states.isEmpty():
            return reduce(DataFrame.union, found)


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """forms: word, form. Returns word, root: the end of the chain of forms, by doubling the steps until no word moves."""
    now = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        facts = scratch.write(now.groupBy("root").agg(F.count("*").alias("m")).join(on, "root", "left"))
        now = scratch.write(hot_join(now.select("word", "root"), facts, ["root"], "m", HELD).select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """words: word, n. Adds form (the most frequent word one edit away, of equals the first, if it is ``ratio`` times as frequent), root, n_near, form_n."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.write(words.select("word", "n"))
    pairs = neighbours(words, scratch)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("b"))
    formed = F.coalesce(-F.col("b.m") >= ratio * F.col("n"), F.lit(False))
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("b.near")).alias("form"), F.when(formed, -F.col("b.m")).alias("form_n"))
    out = scratch.write(out)
    ends = roots(out.where("form IS NOT NULL"), scratch)
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    return forms(word_counts(docs))
