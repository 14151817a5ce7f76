"""URL filters: host and path rules, and a ratio of two character language models for all other urls. SQL only.

Urls that a rule decides are the labelled ones. Two variable-order Markov models over a folded url (all behind its
``://``, with query and fragment; 34 symbols) are counted, one on accepted and one on rejected urls; a context of three symbols backs off to shorter ones by Witten-Bell
smoothing. A url's score is the difference of its two log likelihoods, divided by its length. The cut is calibrated on
a fifth of the labelled urls that the models don't see: the one with the least balanced error.

Counts cover all labelled urls. What is broadcast is a table of n-grams of four out of 34 symbols, which can't have more
than 34**4 = 1.3 million rows, however large the input. Pages are exploded to n-grams and summed again by a row number
made in the scan, so the sums combine before the shuffle and no host or url gathers rows of other pages.

Defined results: urls that are null or without ``://`` have an empty host and path, no rule, score null and verdict
``allow``; without labelled urls of both kinds the cut is 0 and the smoothed models score alike, so the verdict is
``allow``; of rules of equal length the first wins; repeated rows are judged one by one; an empty table gives an empty
table; other columns are ignored. Urls are taken whole: a very long one is a row for each of its symbols, which are summed
in the task that reads it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4  #: symbols of the longest n-gram
SYMBOLS = 34
#: Longest rules a call takes; a when() chain stays small.
MAX_RULES = 1000


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """rules: (verdict, host and path prefix). The longest that fits, and its verdict."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        of, _, prefix = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit("/" + prefix))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def folded(url: Column) -> Column:
    """Lower case, digits as 0, anything rare as ~; start and end are marked."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(url, UPPER, LOWER), "[0-9]", "0"), "[^a-z0/._-]", "~")
    return F.concat(F.lit("^" * (ORDER - 1)), plain, F.lit("$"))


def grams(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gram", F.explode(F.transform(F.sequence(F.lit(1), F.length("folded") - (ORDER - 1)), lambda i: F.substring(F.col("folded"), i, F.lit(ORDER))))).drop("folded")


def log_ratio(counted: DataFrame) -> DataFrame:
    """counted: gram, ok, bad (how often in accepted and rejected urls). Per gram: the difference of log probabilities of its last symbol after the others."""
    model = counted.select("gram")
    total = counted.agg(F.coalesce(F.sum("ok"), F.lit(0)).alias("ok"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    prob = {k: F.lit(1.0 / SYMBOLS) for k in ("ok", "bad")}
    for n in range(1, ORDER + 1):
        tail = F.substring("gram", ORDER - n + 1, n)
        by_gram = counted.groupBy(tail.alias("g")).agg(*(F.sum(k).alias(f"n_{k}") for k in prob))
        if n == 1:
            by_context = None
            model = model.join(F.broadcast(by_gram.withColumnRenamed("g", "g1")), F.substring("gram", ORDER, 1) == F.col("g1"), "left")
            for k in prob:
                prob[k] = (F.coalesce(f"n_{k}", F.lit(0)) + 1.0) / (total[k] + SYMBOLS)
        else:
            by_context = by_gram.groupBy(F.substring("g", 1, n - 1).alias("c")).agg(*(F.sum(f"n_{k}").alias(f"c_{k}") for k in prob), *(F.sum((F.col(f"n_{k}") > 0).cast("long")).alias(f"t_{k}") for k in prob))
            model = model.join(F.broadcast(by_gram), tail == F.col("g"), "left").join(F.broadcast(by_context), F.substring("gram", ORDER - n + 1, n - 1) == F.col("c"), "left")
            for k in prob:
                seen, kinds = F.coalesce(f"c_{k}", F.lit(0)), F.coalesce(f"t_{k}", F.lit(0))
                prob[k] = F.when(seen > 0, (F.coalesce(f"n_{k}", F.lit(0)) + kinds * F.col(f"p_{k}")) / (seen + kinds)).otherwise(F.col(f"p_{k}"))
        model = model.select("gram", *(p.alias(f"p_{k}") for k, p in prob.items()))
    return model.select("gram", (F.log("p_ok") - F.log("p_bad")).alias("ratio"))


def least_error(bins: list[tuple[float, int, int]]) -> float:
    """bins: score, accepted, rejected, by score. The score below which least is judged wrongly (as shares of each kind), in the middle between two bins; 0 without both kinds."""
    ok, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not ok or not bad:
        return 0.0
    best, cut, below_ok, below_bad, before = 2.0, 0.0, 0, 0, bins[0][0] - 0.01
    for score, n_ok, n_bad in bins:
        error = below_ok / ok + (bad - below_bad) / bad
        if error < best:
            best, cut = error, (before + score) / 2
        below_ok, below_bad, before = below_ok + n_ok, below_bad + n_bad, score
    return cut


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule``, ``verdict``, ``score``."""
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"))
    host, path = host_path(F.col("url"))
    rows = rows.select("id", "url", host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    bare = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END")
    rows = rows.select("id", "host", "path", rule.alias("rule"), ruled.alias("ruled"), folded(bare).alias("folded"), (F.pmod(F.xxhash64("url"), F.lit(5)) == 0).alias("test"))

    learn = lambda kind: ((F.col("ruled") == kind) & ~F.col("test")).cast("long")
    scratch = Scratch(pages.sparkSession, "urls")
    counted = grams(rows.select("folded", F.coalesce(learn("allow"), F.lit(0)).alias("ok"), F.coalesce(learn("block"), F.lit(0)).alias("bad")).where("folded IS NOT NULL")).groupBy("gram").agg(F.sum("ok").alias("ok"), F.sum("bad").alias("bad"))
    counted = scratch.write(counted)
    ratio = scratch.write(log_ratio(counted))

    def scored(rows: DataFrame, keep: list[str]) -> DataFrame:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        joined = grams(rows.where("folded IS NOT NULL")).join(F.broadcast(ratio), "gram")
        return joined.groupBy("row", *keep).agg(F.avg("ratio").alias("score"))

    test = scored(rows.where("test AND ruled IS NOT NULL").select("folded", "ruled"), ["ruled"])
    binned = test.groupBy(F.round("score", 2).alias("bin")).agg(F.sum((F.col("ruled") == "allow").cast("long")).alias("ok"), F.sum((F.col("ruled") == "block").cast("long")).alias("bad"))
    bins = sorted(binned.collect())  # two decimals of a bounded number: a few thousand rows at most
    cut = least_error([(b["bin"], b["ok"], b["bad"]) for b in bins])

    keep = ["id", "host", "path", "rule", "ruled"]
    out = scored(rows.select("folded", *keep), keep).unionByName(rows.where("folded IS NULL").select(F.lit(None).cast("long").alias("row"), *keep, F.lit(None).cast("double").alias("score")))
    verdict = F.coalesce("ruled", F.when(F.col("score") < cut, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
