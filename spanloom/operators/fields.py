"""Operators on the fields of tokens: projections, so they cost no shuffle unless they look at a sentence's attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators.relation import BadData, Relation, check_names, col
from spanloom.sources.corpus import KEYS, Corpus, check_fields


def _with_tokens(corpus: Corpus, *columns: Column) -> Corpus:
    return corpus.with_level("token", corpus.tokens.select(*KEYS["token"], *columns))


def _bare(names: Sequence[str]) -> list[str]:
    """A slash at the end marks a set-valued field and isn't part of what must be unique."""
    return [n.rstrip("/") for n in names]


def name(corpus: Corpus, names: Sequence[str]) -> Corpus:
    """Name all fields by position."""
    if len(names) != len(corpus.fields):
        raise BadData(f"{len(corpus.fields)} fields, {len(names)} names")
    return rename(corpus, dict(zip(corpus.fields, names, strict=True)))


def rename(corpus: Corpus, mapping: Mapping[str, str]) -> Corpus:
    check_fields(corpus, list(mapping))
    after = [mapping.get(f, f) for f in corpus.fields]
    check_names(_bare(after))
    return _with_tokens(corpus, *(col(f).alias(n) for f, n in zip(corpus.fields, after, strict=True)))


def keep(corpus: Corpus, names: Sequence[str], rest: str | None = None) -> Corpus:
    """The named fields in that order; where ``rest`` stands among the names, all others."""
    check_fields(corpus, [n for n in names if n != rest])
    others = [f for f in corpus.fields if f not in names]
    return _with_tokens(corpus, *(col(f) for n in names for f in (others if n == rest else [n])))


def drop(corpus: Corpus, names: Sequence[str] = (), dotted: bool = False) -> Corpus:
    """The named fields go, and with ``dotted`` all with a dot in the name."""
    check_fields(corpus, names)
    left = [f for f in corpus.fields if f not in names and not (dotted and "." in f)]
    if not left:
        raise BadData("no field would be left")
    return keep(corpus, left)


def reset(corpus: Corpus, fields: Sequence[str], attribute: str, values: Sequence[str], negate: bool = False, by: str = "_") -> Corpus:
    """Overwrite fields in sentences whose attribute is one of the values (or, negated, none of them)."""
    check_fields(corpus, fields)
    has = F.coalesce(F.col("attrs")[attribute], F.lit("")).isin(list(values))
    marks = corpus.sentences.select(*KEYS["sentence"], (~has if negate else has).alias("__reset"))
    tokens = corpus.tokens.join(marks, KEYS["sentence"], "left")
    return corpus.with_level("token", tokens.select(*KEYS["token"], *(F.when(F.col("__reset"), by).otherwise(col(f)).alias(f) if f in fields else col(f) for f in corpus.fields)))


def redact_long(corpus: Corpus, field: str, longest: int, **how) -> Corpus:
    check_fields(corpus, [field])
    return _with_tokens(corpus, *(T.redact_long(col(f), longest, **how).alias(f) if f == field else col(f) for f in corpus.fields))


def tidy(corpus: Corpus, fields: Sequence[str] | None = None) -> Corpus:
    """Single spaces, no soft hyphens, repaired characters; what becomes empty is _."""
    done = lambda f: F.coalesce(F.nullif(T.collapse_spaces(T.drop_soft_hyphens(T.repair_characters(col(f)))), F.lit("")), F.lit("_"))
    return _with_tokens(corpus, *(done(f).alias(f) if fields is None or f in fields else col(f) for f in corpus.fields))


def add_fields(corpus: Corpus, **new: Column) -> Corpus:
    check_names(_bare(list(new)), _bare(corpus.fields), new=True)
    return _with_tokens(corpus, *map(col, corpus.fields), *(e.alias(n) for n, e in new.items()))


def split_after_stop(corpus: Corpus, field: str = "word") -> Corpus:
    """A token ``low.Cap`` lacks a space: it becomes low, the stop, and Cap, and Cap starts a sentence of its own.

    Pieces are numbered within the old sentence by (token, piece); a sentence's part is the number of starts before.
    """
    check_fields(corpus, [field])
    from pyspark.sql.window import Window

    parts = F.regexp_extract(col(field), r"^(\p{L}*\p{Ll})([.!?])(\p{Lu}\p{L}*)$", 1)
    pieces = F.when(parts != "", F.array(*(F.regexp_extract(col(field), r"^(\p{L}*\p{Ll})([.!?])(\p{Lu}\p{L}*)$", i) for i in (1, 2, 3)))).otherwise(F.array(col(field)))
    tokens = corpus.tokens.select("*", F.posexplode(pieces).alias("__piece", "__word"))
    inside = Window.partitionBy(*KEYS["sentence"]).orderBy("tok_no", "__piece")
    tokens = tokens.withColumn("__part", F.sum((F.col("__piece") == 2).cast("long")).over(inside))
    tokens = tokens.withColumn("__tok", F.row_number().over(Window.partitionBy(*KEYS["sentence"], "__part").orderBy("tok_no", "__piece")).cast("long"))
    starts = tokens.select(*KEYS["sentence"], "__part").distinct()
    order = Window.partitionBy("text_id", "para_no").orderBy("sent_no", "__part")
    numbers = starts.withColumn("__sent", F.row_number().over(order).cast("long"))
    done = tokens.join(numbers, [*KEYS["sentence"], "__part"]).select("text_id", "para_no", F.col("__sent").alias("sent_no"), F.col("__tok").alias("tok_no"), *(F.col("__word").alias(f) if f == field else col(f) for f in corpus.fields))
    sents = corpus.sentences.join(numbers, KEYS["sentence"]).select("text_id", "para_no", F.col("__sent").alias("sent_no"), "attrs")
    return corpus._replace(sentences=sents, tokens=done)


def data(corpus: Corpus, fields: Sequence[str] | None = None, tag: str | None = None) -> Relation:
    """Tokens as a relation: without duplicates, or each with a running number."""
    fields = list(fields or corpus.fields)
    check_fields(corpus, fields)
    if not tag:
        return Relation(corpus.tokens.select(*map(col, fields)))
    from spanloom.operators.relation import numbered

    rows = numbered(corpus.tokens, [F.col(k) for k in KEYS["token"]], tag)
    return Relation(rows.select(*map(col, fields), F.col(tag).cast("string").alias(tag)), distinct=False)


def meta(corpus: Corpus, level: str, attributes: Sequence[str], missing: str = "") -> Relation:
    """The attributes of a level's elements as a relation."""
    return Relation(corpus.level(level).select(*(F.coalesce(F.col("attrs")[a], F.lit(missing)).alias(a) for a in attributes)))
