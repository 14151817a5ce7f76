"""Operators on texts, paragraphs and sentences: select, join attributes, sort, sample, deduplicate, partition, split, number."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.functions import text as T
from spanloom.operators.relation import BadData, numbered, running_sum
from spanloom.session import Scratch
from spanloom.sources.corpus import KEYS, LEVELS, Corpus, sentence_arrays


def attr(name: str) -> Column:
    """An attribute; empty where it is missing."""
    return F.coalesce(F.col("attrs")[name], F.lit(""))


# -- selection


def matches(value: Column, pattern: str) -> Column:
    """The pattern fits the whole value."""
    return F.rlike(value, F.lit(f"^(?:{pattern})$"))


def select(corpus: Corpus, level: str, tests: Sequence[tuple[str, str, str | Sequence[str]]], how: str = "all", drop: bool = False) -> Corpus:
    """Keep (or drop) elements by tests: (attribute, ``=`` or ``!=``, pattern), or ``in`` / ``not in`` with a list of values."""
    conditions = []
    for name, op, what in tests:
        if op not in ("=", "!=", "in", "not in"):
            raise BadData(f"unknown test: {op}")
        fits = matches(attr(name), what) if op in ("=", "!=") else attr(name).isin(list(what))
        conditions.append(~fits if op in ("!=", "not in") else fits)
    chosen = F.lit(how == "all")
    for c in conditions:
        chosen = (chosen & c) if how == "all" else (chosen | c)
    return corpus.restrict(level, corpus.level(level).where(~chosen if drop else chosen))


def select_in(corpus: Corpus, level: str, attribute: str, values: DataFrame, drop: bool = False) -> Corpus:
    """As ``select`` with a list of values of any size: a table whose first column holds them."""
    found = corpus.level(level).join(values.select(F.col(values.columns[0]).alias("__v")).distinct(), attr(attribute) == F.col("__v"), "left_anti" if drop else "left_semi")
    return corpus.restrict(level, found)


def with_tokens(corpus: Corpus, condition: Column, level: str = "text") -> Corpus:
    """Elements that hold a token of this kind."""
    return corpus.restrict(level, corpus.tokens.where(condition))


def drop_empty(corpus: Corpus) -> Corpus:
    """Elements without tokens go, at every level."""
    for level in LEVELS:
        keys = KEYS[level]
        corpus = corpus.with_level(level, corpus.level(level).join(corpus.tokens.select(*keys).distinct(), keys, "left_semi"))
    return corpus


def remove(corpus: Corpus, level: str, tests: Sequence[tuple[str, str, str]]) -> Corpus:
    """Elements that meet the tests go with all that they hold. Elements without attributes are never tested."""
    hit = F.size("attrs") > 0
    for name, op, pattern in tests:
        fits = matches(attr(name), pattern)
        hit = hit & (~fits if op == "!=" else fits)
    keys, gone = KEYS[level], corpus.level(level).where(hit).select(*KEYS[level])
    out = corpus
    for below in (*LEVELS, "token"):
        if len(KEYS[below]) >= len(keys):
            out = out.with_level(below, out.level(below).join(gone, keys, "left_anti"))
    return out


def mask(corpus: Corpus, level: str, tests: Sequence[tuple[str, str, str]], by: str = "_", keep: Mapping[str, Sequence[str]] | None = None, add: Mapping[str, str] | None = None, attribute_by: str | None = None) -> Corpus:
    """Elements that meet the tests keep their shape, not their content.

    In them, the fields of tokens and the attributes of the element and of those it holds become ``by`` (attributes
    ``attribute_by``), sets ``|by|``. keep: attributes, by level, that stay; add: what the element itself gets besides.
    """
    hit = F.size("attrs") > 0
    for name, op, pattern in tests:
        fits = matches(attr(name), pattern)
        hit = hit & (~fits if op == "!=" else fits)
    keys = KEYS[level]
    marks = corpus.level(level).where(hit).select(*keys, F.lit(True).alias("__masked"))

    def hidden(value: Column, by: str) -> Column:
        return F.when(F.startswith(value, F.lit("|")), f"|{by}|").otherwise(by)

    def masked(stays: list[str]):
        return lambda k, v: F.when(k.isin(stays), v).otherwise(hidden(v, by if attribute_by is None else attribute_by))

    out = corpus
    for below in LEVELS:
        if len(KEYS[below]) < len(keys):
            continue
        given = F.transform_values("attrs", masked(list((keep or {}).get(below, ())) or ["\0"]))
        if below == level and add:
            given = F.map_concat(F.map_filter(given, lambda k, v: ~k.isin(list(add))), F.create_map(*(F.lit(x) for pair in add.items() for x in pair)))
        rows = corpus.level(below).join(marks, keys, "left")
        out = out.with_level(below, rows.select(*KEYS[below], F.when(F.col("__masked"), given).otherwise(F.col("attrs")).alias("attrs")))
    tokens = corpus.tokens.join(marks, keys, "left")
    return out.with_level("token", tokens.select(*KEYS["token"], *(F.when(F.col("__masked"), hidden(F.col(f"`{f}`"), by)).otherwise(F.col(f"`{f}`")).alias(f) for f in corpus.fields)))


# -- attributes


def drop_attributes(corpus: Corpus, level: str, pattern: str, keep: Sequence[str] = ()) -> Corpus:
    rows = corpus.level(level)
    return corpus.with_level(level, rows.withColumn("attrs", F.map_filter("attrs", lambda k, v: k.isin(list(keep)) | ~F.rlike(k, F.lit(f"^(?:{pattern})$")))))


def rename_attributes(corpus: Corpus, level: str, mapping: Mapping[str, str]) -> Corpus:
    lookup = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return corpus.with_level(level, corpus.level(level).withColumn("attrs", F.transform_keys("attrs", lambda k, v: F.coalesce(lookup[k], k))))


def set_attributes(corpus: Corpus, level: str, **new: Column) -> Corpus:
    given = F.create_map(*(x for n, e in new.items() for x in (F.lit(n), e.cast("string"))))
    others = F.map_filter("attrs", lambda k, v: ~k.isin(list(new)))
    return corpus.with_level(level, corpus.level(level).withColumn("attrs", F.map_concat(others, given)))


def unify_attributes(corpus: Corpus, level: str, default: str = "", first: Sequence[str] = (), last: Sequence[str] = (), always: Sequence[str] = (), only: Sequence[str] | None = None, drop: Sequence[str] = ()) -> Corpus:
    """All elements get the same attributes, as one struct-like map: those that occur in any, in the order first, others by name, last."""
    rows = corpus.level(level)
    listed = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    names = rows.select(F.explode(F.map_keys("attrs")).alias("k")).union(rows.sparkSession.range(1).select(F.explode(listed(always)))).where(~F.array_contains(listed(drop), F.col("k")))
    if only is not None:
        names = names.where(F.array_contains(listed(only), F.col("k")))
    place = lambda of: F.array_position(listed(of), F.col("k")).cast("int")
    order = F.when(place(first) > 0, place(first) - len(first) - 1).otherwise(place(last))
    # names, not values: the head of the table, in one row that meets each element
    head = names.distinct().agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), "k"))), lambda x: x["k"]).alias("__names"))
    given = F.map_from_entries(F.transform("__names", lambda n: F.struct(n, F.coalesce(F.element_at("attrs", n), F.lit(default)))))
    return corpus.with_level(level, rows.crossJoin(F.broadcast(head)).withColumn("attrs", given).drop("__names"))


def add_attributes(corpus: Corpus, level: str, attribute: str, table: DataFrame, key: str, overwrite: bool = False) -> Corpus:
    """Left join by an attribute. Of rows with one key the last (by ``line`` where there is such a column, else by values) wins; without a match, values are empty."""
    new = [c for c in table.columns if c not in (key, "line")]
    order = F.struct("line", *new) if "line" in table.columns else F.struct(*new)
    one = table.groupBy(F.col(key).alias("__key")).agg(F.max(order).alias("__row"))
    joined = corpus.level(level).join(one, attr(attribute) == F.col("__key"), "left")
    given = F.create_map(*(x for c in new for x in (F.lit(c), F.coalesce(F.col("__row")[c].cast("string"), F.lit("")))))
    merged = F.map_concat(F.map_filter("attrs", lambda k, v: ~k.isin(new)), given) if overwrite else F.map_concat("attrs", F.map_filter(given, lambda k, v: ~F.array_contains(F.map_keys("attrs"), k)))
    return corpus.with_level(level, joined.select(*KEYS[level], merged.alias("attrs")))


def zip_attributes(corpus: Corpus, level: str, table: DataFrame, order: str) -> Corpus:
    """The n-th row of a table (by its column ``order``) goes to the n-th element. Too few rows are an error."""
    new = [c for c in table.columns if c != order]
    elements = numbered(corpus.level(level), [F.col(k) for k in KEYS[level]], "__n")
    rows = numbered(table, [F.col(order)], "__n").select("__n", F.create_map(*(x for c in new for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit(""))))).alias("__new"))
    joined = elements.join(rows, "__n", "left")
    given = F.when(F.col("__new").isNotNull(), F.map_concat(F.map_filter("attrs", lambda k, v: ~k.isin(new)), "__new")).otherwise(F.raise_error(F.lit("the table has fewer rows than there are elements")).cast("map<string,string>"))
    return corpus.with_level(level, joined.select(*KEYS[level], given.alias("attrs")))


def add_ids(corpus: Corpus, level: str, name: str = "id", prefix: str = "", width: int = 0, within: bool = True) -> Corpus:
    """Running numbers, within the element above or over the whole."""
    keys = KEYS[level]
    nr = numbered(corpus.level(level), [F.col(k) for k in keys], "__nr", [F.col(k) for k in keys[:-1]] if within and len(keys) > 1 else ())
    value = F.concat(F.lit(prefix), T.padded(F.col("__nr").cast("string"), width))
    out = set_attributes(corpus.with_level(level, nr), level, **{name: value})
    return out.with_level(level, out.level(level).drop("__nr"))


#: A place in a format of ids: {id}, {hash} or {level[attribute]}, with a width (zeros in front, x for hex digits) or a precision, or /pattern/replacement/.
PLACE = re.compile(r"\{(?P<what>id|hash|idnum\[(?P<of>\w+)\]|(?P<level>\w+)\[(?P<name>[\w.-]+)\])(?:/(?P<pattern>[^/]*)/(?P<by>[^/]*)/)?(?::(?P<spec>[^}]*))?\}")


def compose_ids(corpus: Corpus, level: str, form: str, name: str = "id", start: int = 1, step: int = 1, hash_of: str = "", prefix: str = "") -> Corpus:
    """Ids by a format, from running numbers over the whole and attributes of the element and those above it.

    ``{id}`` is the element's number, ``{idnum[text]}`` that of the text it is in, ``{text[title]}`` an attribute (``this``
    is the element itself), ``{hash}`` the hex SHA-1 of ``hash_of``. ``:04d`` pads a number, ``:06x`` shows it in hex,
    ``:.8`` cuts a string, ``/pattern/replacement/`` replaces all matches in it.
    """
    places = list(PLACE.finditer(form))
    if re.sub(r"[{}]", "", PLACE.sub("", form)) != PLACE.sub("", form):
        raise BadData(f"bad format: {form}")
    above = [x for x in LEVELS if len(KEYS[x]) <= len(KEYS[level])]
    named = lambda x: level if x == "this" else x
    if off := [m[0] for m in places if (x := m["of"] or m["level"]) and named(x) not in above]:
        raise BadData(f"not around a {level}: {off}")
    rows = corpus.level(level)
    numbers = {level} | {named(m["of"]) for m in places if m["of"]}
    for x in numbers:
        nr = numbered(corpus.level(x).select(*KEYS[x]), [F.col(k) for k in KEYS[x]], f"__{x}_nr")
        rows = rows.join(nr.withColumn(f"__{x}_nr", F.lit(start) + (F.col(f"__{x}_nr") - 1) * step), KEYS[x])
    for x in {named(m["level"]) for m in places if m["level"]} - {level}:
        rows = rows.join(corpus.level(x).select(*KEYS[x], F.col("attrs").alias(f"__{x}_attrs")), KEYS[x])
    parts, at = [F.lit(prefix)], 0
    for m in places:
        parts.append(F.lit(form[at : m.start()]))
        at = m.end()
        spec = m["spec"] or ""
        if m["level"]:
            x = named(m["level"])
            value = F.coalesce(F.col("attrs" if x == level else f"__{x}_attrs")[m["name"]], F.lit(""))
            if m["pattern"] is not None:
                value = F.regexp_replace(value, m["pattern"], m["by"])
        elif m["what"] == "hash":
            value = F.sha1(F.lit(hash_of))
        else:
            n = F.col(f"__{named(m['of']) if m['of'] else level}_nr")
            value = T.padded(F.lower(F.hex(n)) if spec.endswith("x") else n.cast("string"), int(re.sub(r"\D", "", spec) or 0))
            spec = ""
        if spec.startswith("."):
            value = F.substring(value, 1, int(spec[1:]))
        parts.append(value)
    rows = rows.withColumn("__id", F.concat(*parts, F.lit(form[at:])))
    out = set_attributes(corpus.with_level(level, rows), level, **{name: F.col("__id")})
    return out.with_level(level, out.level(level).select(*KEYS[level], "attrs"))


def hash_ids(corpus: Corpus, level: str, name: str = "id", length: int = 12) -> Corpus:
    """The first hex digits of SHA-1 over an element's key and attributes: the same in every run."""
    key = F.concat_ws("\x1f", *(F.col(k).cast("string") for k in KEYS[level]), F.to_json("attrs"))
    return set_attributes(corpus, level, **{name: F.substring(F.sha1(key), 1, length)})


def random_ids(corpus: Corpus, level: str, name: str = "id", seed: int = 0, below: int = 1 << 31) -> Corpus:
    """Unique integers below a bound that look random: ranks in hash order, spread by an odd multiplier."""
    rows = corpus.level(level)
    if rows.count() > below:
        raise BadData("more elements than ids")
    if below & (below - 1):
        raise BadData("the bound must be a power of two")
    nr = numbered(rows, [F.xxhash64(*KEYS[level], F.lit(seed)), *(F.col(k) for k in KEYS[level])], "__nr")
    spread = F.col("__nr").cast("decimal(19,0)") * F.lit(2654435761 % below | 1).cast("decimal(19,0)")  # wider than 64 bits
    value = (spread % F.lit(below).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")
    out = set_attributes(corpus.with_level(level, nr), level, **{name: value})
    return out.with_level(level, out.level(level).drop("__nr"))


# -- histograms of sentences


def weighted_set(counted: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """|v:n|...| by key, the most frequent first, ties by value."""
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("m"), F.col(value).alias("v"))))
    shown = F.transform(pairs, lambda x: F.concat(x["v"], F.lit(":"), (-x["m"]).cast("string")))
    return counted.groupBy(*keys).agg(F.concat(F.lit("|"), F.array_join(shown, "|"), F.lit("|")).alias("value"))


def sum_sentence_class(corpus: Corpus, attribute: str, into: str) -> Corpus:
    """Texts and paragraphs get a histogram of an attribute of their sentences."""
    counted = corpus.sentences.select("text_id", "para_no", attr(attribute).alias("v")).groupBy("text_id", "para_no", "v").agg(F.count("*").alias("n"))
    above = counted.groupBy("text_id", "v").agg(F.sum("n").alias("n"))
    for level, rows in (("paragraph", counted), ("text", above)):
        made = weighted_set(rows, KEYS[level], "v", "n")
        joined = corpus.level(level).join(made, KEYS[level], "left").withColumn("value", F.coalesce("value", F.lit("|")))
        done = set_attributes(corpus.with_level(level, joined), level, **{into: F.col("value")})
        corpus = done.with_level(level, done.level(level).drop("value"))
    return corpus


def main_values(counted: DataFrame, keys: Sequence[str], value: str, n: str, listed: Sequence[str] = ()) -> DataFrame:
    """By key: the values that are the most frequent (all that tie) or listed, joined by -, in order; ``other`` where none is."""
    top = F.max(n).over(Window.partitionBy(*keys))
    chosen = counted.withColumn("__top", top).where((F.col(n) == F.col("__top")) | F.col(value).isin(list(listed)))
    return chosen.groupBy(*keys).agg(F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(value)), "-"), F.lit("")), F.lit("other")).alias("main"))


# -- order and samples


def sort_keys(value: Column, flags: str = "") -> Column:
    """One sort key: n or g numbers, f without case, d letters and digits only, i without what can't be seen, M months, b without blanks in front, V versions, r descending, R by hash."""
    key = value
    if "b" in flags:
        key = F.ltrim(key)
    if "i" in flags:
        key = F.regexp_replace(key, r"[\p{C}]", "")
    if "d" in flags:
        key = F.regexp_replace(key, r"[^\p{L}\p{N} ]", "")
    if "f" in flags:
        key = F.upper(key)
    if "n" in flags or "g" in flags:
        key = F.coalesce(F.regexp_extract(key, r"^\s*(-?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)" if "g" in flags else r"^\s*(-?[0-9]*\.?[0-9]+)", 1).try_cast("double"), F.lit(0.0))
    elif "h" in flags:
        factor = F.element_at(F.create_map(*(F.lit(x) for i, u in enumerate("KMGTP", 1) for x in (u, 1024.0**i))), F.upper(F.regexp_extract(key, r"([kKMGTP])\s*$", 1)))
        key = F.coalesce(F.regexp_extract(key, r"^\s*(-?[0-9.]+)", 1).try_cast("double"), F.lit(0.0)) * F.coalesce(factor, F.lit(1.0))
    elif "M" in flags:
        months = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
        key = F.coalesce(F.array_position(F.array(*map(F.lit, months)), F.upper(F.substring(F.ltrim(key), 1, 3))), F.lit(0))
    elif "V" in flags:
        key = F.transform(F.regexp_extract_all(key, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)), lambda p: F.struct(F.coalesce(p.try_cast("decimal(38,0)"), F.lit(-1)), p))
    elif "R" in flags:
        key = F.xxhash64(key)
    return key.desc() if "r" in flags else key.asc()


def sort_texts(corpus: Corpus, keys: Sequence[tuple[str, str]], transform: str | None = None, name: str = "order") -> Corpus:
    """Texts get their place by attributes (name, flags) as an attribute; ties stay in order. ``transform`` is a SQL expression over ``value``."""
    rows = corpus.texts
    order = []
    for i, (a, flags) in enumerate(keys):
        rows = rows.withColumn("value", attr(a)).withColumn(f"__k{i}", F.coalesce(F.expr(f"CAST(({transform}) AS STRING)"), F.lit("")) if transform else F.col("value"))
        order.append(sort_keys(F.col(f"__k{i}"), flags))
    ranked = numbered(rows, [*order, F.col("text_id").asc()], "__nr")
    made = set_attributes(corpus.with_level("text", ranked), "text", **{name: F.col("__nr")})
    return made.with_level("text", made.texts.select("text_id", "attrs"))


def scramble(corpus: Corpus, seed: int = 0) -> Corpus:
    """Sentences change places within their paragraph, by hash order."""
    keys = KEYS["sentence"]
    place = F.row_number().over(Window.partitionBy("text_id", "para_no").orderBy(F.xxhash64(*keys, F.lit(seed)), "sent_no")).cast("long")
    moved = corpus.sentences.select(*keys, place.alias("__to"))
    put = lambda df: df.join(moved, keys).withColumn("sent_no", F.col("__to")).drop("__to")
    return corpus._replace(sentences=put(corpus.sentences).select(*keys, "attrs"), tokens=put(corpus.tokens).select(*corpus.tokens.columns))


def sample(corpus: Corpus, level: str, n: int, seed: int = 0) -> Corpus:
    """n elements at random, in their order."""
    keys = KEYS[level]
    chosen = corpus.level(level).select(*keys).orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)
    return corpus.restrict(level, chosen)


def sample_tokens(corpus: Corpus, n: int, seed: int = 0) -> DataFrame:
    keys = KEYS["token"]
    return corpus.tokens.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n).orderBy(*keys)


def seeds(corpus: Corpus, length: int, distance: int, most: int | None = None, how: str = "even", seed: int = 0) -> DataFrame:
    """Every ``distance``-th stretch of ``length`` tokens of a sentence, as one string; with ``most``, that many of them at most, evenly spaced in order or at random."""
    words = sentence_arrays(corpus).select(*KEYS["sentence"], F.transform("t", lambda x: x["word"]).alias("w")).where(F.size("w") >= length)
    starts = F.sequence(F.lit(1), F.size("w") - length + 1, F.lit(distance))
    found = words.select(*KEYS["sentence"], F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(length)), " "))).alias("seed_no", "seed"))
    if most is None:
        return found
    keys = [*KEYS["sentence"], "seed_no"]
    if how == "random":
        return found.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(most)
    # a seed's place is told by how many seeds the texts before its own have, so only texts with chosen ones are looked at again
    texts = Scratch(words.sparkSession, "seeds").write(words.groupBy("text_id").agg(F.sum(F.size(starts)).cast("long").alias("__n")))
    n = texts.agg(F.sum("__n")).first()[0] or 0
    if n <= most:
        return found
    # the k-th of ``most`` is the first whose share of the order reaches k / most
    step = lambda nr: F.floor(nr * most / n)
    upto = running_sum(texts, [F.col("text_id")], F.col("__n"), "__upto")
    hold = upto.select(F.col("text_id").alias("__text"), (F.col("__upto") - F.col("__n")).alias("__before"), "__upto").where(step(F.col("__upto")) > step(F.col("__before")))
    near = found.join(hold.drop("__upto"), F.col("text_id").eqNullSafe(F.col("__text")))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("text_id").orderBy(*keys))
    return near.withColumn("__nr", place).where(step(F.col("__nr")) > step(F.col("__nr") - 1)).select(*keys, "seed")


def content_hash(corpus: Corpus, level: str) -> DataFrame:
    """Keys of a level and the MD5 of its tokens in order; a sentence is hashed first, then the hashes of sentences."""
    keys = KEYS[level]
    token = lambda x: F.concat_ws("\t", *(x[f] for f in corpus.fields))
    sents = sentence_arrays(corpus).select(*KEYS["sentence"], F.md5(F.array_join(F.transform("t", token), "\n")).alias("h"))
    if level == "sentence":
        return sents
    inner = [k for k in KEYS["sentence"] if k not in keys]
    return sents.groupBy(*keys).agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*inner, "h"))), lambda x: x["h"]), "\n")).alias("h"))


def deduplicate(corpus: Corpus, level: str = "text", by: str = "content", ignore: Sequence[str] = (), within: Sequence[str] = ()) -> Corpus:
    """The first of elements with equal content, attributes (but for those ignored), or both stays. The smallest key is an aggregate, so many equal elements meet in no task."""
    rows = corpus.level(level)
    keys = KEYS[level]
    rows = rows.join(content_hash(corpus, level), keys, "left") if by != "attributes" else rows.withColumn("h", F.lit(""))
    shown = F.to_json(F.array_sort(F.map_entries(F.map_filter("attrs", lambda k, v: ~k.isin(list(ignore) or ["\0"])))))
    what = {"content": [F.col("h")], "attributes": [shown], "both": [F.col("h"), shown]}[by]
    first = rows.groupBy(*within, *(w.alias(f"__w{i}") for i, w in enumerate(what))).agg(F.min(F.struct(*keys)).alias("k")).select("k.*")
    return corpus.restrict(level, first)


# -- partitions and splits


def partition(corpus: Corpus, tag: Column, name: str = "tag") -> Corpus:
    """Texts get the value of a function of their attributes, by which ``write_vertical`` makes folders."""
    return set_attributes(corpus, "text", **{name: tag})


def split_sizes(rows: DataFrame, order: Sequence[str], size: str, most: int, most_rows: int = 0, together: str | None = None) -> DataFrame:
    """Number parts so that none but single larger rows exceeds ``most`` (or ``most_rows`` rows, 0: any): adds ``part_no``.

    A part ends where the next row would overflow it. With ``together``, rows in succession with one value of that column
    are one.

    What ends a part depends on where it began, so this is a walk in order; yet it needs no task that sees all rows. Rows
    are cut into stretches of a few parts each. In a stretch, the later the open part began, the later is the first cut,
    and so are all others; so the stretch as a whole is a rising step function from where the open part began to where the
    last one does. These functions have few steps, as walks from different cuts soon meet; they are composed in order (a
    few numbers a stretch), and then each stretch knows where its open part began and is walked alone.
    """
    import numpy as np
    import pandas as pd

    ordered = numbered(rows, [F.col(c) for c in order], "__nr")
    units = ordered.select("__nr", F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("own"), *([F.col(together).alias("k")] if together else []))
    if together:
        last = units.select((F.col("__nr") + 1).alias("__nr"), F.col("k").alias("before"), F.lit(1).alias("there"))
        begins = units.join(last, "__nr", "left").withColumn("begins", (F.col("there").isNull() | ~F.equal_null("k", "before")).cast("long"))
        units = running_sum(begins.select("__nr", "own", "begins"), [F.col("__nr")], F.col("begins"), "u")
    else:
        units = units.withColumn("u", F.col("__nr"))
    scratch = Scratch(rows.sparkSession, "split")
    units = scratch.write(units.select("__nr", "u", "own"))
    whole = units.groupBy("u").agg(F.sum("own").alias("own"), F.count("*").alias("n"))
    whole = running_sum(running_sum(whole, [F.col("u")], F.col("own"), "S").select("u", "own", "n", "S"), [F.col("u")], F.col("n"), "C")
    parts = 8  #: a stretch holds about so many
    share = (F.col("S") - F.col("own")) / (parts * max(1, most)) + ((F.col("C") - F.col("n")) / (parts * most_rows) if most_rows else 0)
    whole = scratch.write(whole.select("u", "S", "C", (F.col("S") - F.col("own")).alias("S0"), (F.col("C") - F.col("n")).alias("C0"), F.floor(share).alias("stretch")))
    limit = most_rows or (1 << 62)

    def cut_after(g: pd.DataFrame, held_s, held_c):
        """The first unit that no longer fits a part which began at these sums."""
        return np.minimum(np.searchsorted(g["S"].to_numpy(), np.asarray(held_s) + most, "right"), np.searchsorted(g["C"].to_numpy(), np.asarray(held_c) + limit, "right"))

    def steps(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("u")
        n, s0, c0 = len(g), g["S0"].to_numpy(), g["C0"].to_numpy()
        after = np.maximum(cut_after(g, s0, c0), np.arange(n) + 1)
        last, cuts = np.arange(n), np.ones(n, np.int64)
        for j in range(n - 1, -1, -1):
            if after[j] < n:
                last[j], cuts[j] = last[after[j]], 1 + cuts[after[j]]
        new = np.flatnonzero(np.concatenate([[True], (last[1:] != last[:-1]) | (cuts[1:] != cuts[:-1])]))
        return pd.DataFrame({"stretch": g["stretch"].iloc[0], "S": s0[new], "C": c0[new], "last_S": s0[last[new]], "last_C": c0[last[new]], "cuts": cuts[new], "end_S": g["S"].iloc[-1], "end_C": g["C"].iloc[-1]})

    def compose(g: pd.DataFrame) -> pd.DataFrame:
        out, held, part = [], None, 0
        for stretch, f in g.sort_values(["stretch", "C"]).groupby("stretch", sort=True):
            out.append((stretch, *(held or (0, 0)), part))
            if held is None:
                step = f.iloc[0]
            else:
                fits = (f["S"] - held[0] <= most) & (f["C"] - held[1] <= limit)
                if f["end_S"].iloc[0] - held[0] <= most and f["end_C"].iloc[0] - held[1] <= limit:
                    continue
                step = f[fits].iloc[-1] if fits.any() else f.iloc[0]  # the open part is one row that is too large
            held, part = (int(step["last_S"]), int(step["last_C"])), part + int(step["cuts"])
        return pd.DataFrame(out, columns=["stretch", "held_S", "held_C", "before"])

    def walk(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("u").reset_index(drop=True)
        n, part = len(g), int(g["before"].iloc[0])
        at = 0 if part == 0 else int(cut_after(g, g["held_S"].iloc[0], g["held_C"].iloc[0]))
        numbers = np.full(n, part, np.int64)
        while at < n:
            part += 1
            numbers[at:] = part
            at = max(at + 1, int(cut_after(g, g["S0"].iloc[at], g["C0"].iloc[at])))
        return pd.DataFrame({"u": g["u"], "part_no": numbers})

    found = scratch.write(whole.groupBy("stretch").applyInPandas(steps, "stretch long, S long, C long, last_S long, last_C long, cuts long, end_S long, end_C long"))
    entry = found.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(compose, "stretch long, held_S long, held_C long, before long")  # a few rows for every eight parts
    placed = whole.join(entry, "stretch").groupBy("stretch").applyInPandas(walk, "u long, part_no long")
    return ordered.join(units.select("__nr", "u").join(placed, "u").select("__nr", "part_no"), "__nr").drop("__nr")


def split(corpus: Corpus, most_tokens: int, most_texts: int = 0, together: str | None = None) -> Corpus:
    """Texts get the number of the part they go to, in order, by their sizes; those in succession with one value of an attribute stay together."""
    sizes = corpus.tokens.groupBy("text_id").agg(F.count("*").alias("n"))
    rows = corpus.texts.join(sizes, "text_id", "left").na.fill(0, ["n"])
    parts = split_sizes(rows.select("text_id", "n", attr(together or "").alias("k")), ["text_id"], "n", most_tokens, most_texts, "k" if together else None).select("text_id", "part_no")
    out = set_attributes(corpus.with_level("text", corpus.texts.join(parts, "text_id")), "text", part=F.col("part_no"))
    return out.with_level("text", out.texts.select("text_id", "attrs"))


def pack_files(files: DataFrame, most: int, most_files: int = 0) -> DataFrame:
    """files: path, content. Each gets the number of a fragment of at most ``most`` characters; path and order stay, so unpacking is a selection. Only paths and sizes are numbered."""
    sizes = files.select("path", F.length("content").alias("size"))
    return files.join(split_sizes(sizes, ["path"], "size", most, most_files).select("path", "part_no"), "path")


def unpack_files(packed: DataFrame) -> DataFrame:
    return packed.select("path", "content")


# -- shapes


def element_as_line(corpus: Corpus, level: str, field: str = "word", separator: str = " ", attributes: Sequence[str] = (), missing: str = "") -> DataFrame:
    """An element's attributes and, joined, the values of a field."""
    keys = KEYS[level]
    inner = [k for k in KEYS["token"] if k not in keys]
    lines = corpus.tokens.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*inner, F.col(f"`{field}`").alias("v")))), lambda x: x["v"]), separator).alias("line"))
    return corpus.level(level).join(lines, keys, "left").select(*keys, *(F.coalesce(F.col("attrs")[a], F.lit(missing or f"({a})")).alias(a) for a in attributes), F.coalesce("line", F.lit("")).alias("line"))


def paragraphs_from_lines(lines: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Runs of lines between blank ones become paragraphs: adds para_no, drops the blank lines."""
    w = Window.partitionBy(*keys).orderBy(order)
    blank = F.trim(value) == ""
    marked = lines.withColumn("__start", (~blank & F.coalesce(F.lag(blank).over(w), F.lit(True))).cast("long"))
    return marked.withColumn("para_no", F.sum("__start").over(w)).where(~blank).drop("__start")


def thread_paths(posts: DataFrame, id_col: str, parent_col: str, key_col: str) -> DataFrame:
    """id, path: the keys of a post and all its ancestors, from the root, joined by /; sorts a thread as it is read.

    Paths double: each holds the keys up to some ancestor, and takes what that ancestor holds. So rounds are the
    logarithm of the deepest thread. A post whose parent isn't there is a root; on a cycle, and below it, path is null.
    """
    scratch = Scratch(posts.sparkSession, "threads")
    rows = posts.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), F.col(key_col).cast("string").alias("path"))
    there = rows.select(F.col("id").alias("up"), F.lit(True).alias("there"))
    now = scratch.write(rows.join(there, "up", "left").select("id", F.when(F.col("there"), F.col("up")).alias("up"), "path"))
    left, limit = now.where("up IS NOT NULL").count(), now.count()
    reached = 1
    while left and reached <= limit:  # a path of more posts than there are is on a cycle
        above = now.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        open_ = now.where("up IS NOT NULL").join(above, "up").select("id", F.col("next").alias("up"), F.concat_ws("/", "head", "path").alias("path"))
        after = scratch.write(now.where("up IS NULL").union(open_))
        scratch.drop(now)
        now, left, reached = after, after.where("up IS NOT NULL").count(), 2 * reached
    return now.select("id", F.when(F.col("up").isNull(), F.col("path")).alias("path"))


def add_place_names(corpus: Corpus, attribute: str, level: str = "text", tag: str = "PM", none: str = "_") -> Corpus:
    """Fields lemma, pos and msd: the first token of a sentence gets the place that an attribute names and ``tag``, all others ``none``."""
    keys = KEYS[level]
    places = corpus.level(level).select(*keys, attr(attribute).alias("__place"))
    named = F.coalesce("__place", F.lit("")) != ""
    if corpus.arrays is not None:  # sentences are joined, not tokens
        rows = corpus.arrays.join(places, keys, "left").select(*KEYS["sentence"], "__place", F.posexplode("t").alias("pos", "x"))
        rows, first = rows.select(*KEYS["sentence"], (F.col("pos") + 1).cast("long").alias("tok_no"), "x.*", "__place"), named & (F.col("tok_no") == 1)
    else:
        rows = corpus.tokens.join(places, keys, "left")
        first = (F.col("tok_no") == F.min("tok_no").over(Window.partitionBy(*KEYS["sentence"]))) & named
    return corpus.with_level("token", rows.select(*corpus.tokens.columns, F.when(first, F.col("__place")).otherwise(none).alias("lemma"), F.when(first, tag).otherwise(none).alias("pos"), F.lit("").alias("msd")))
