"""Scalar functions on fields and attributes, as Spark expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# -- entities


def escape_field(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def escape_attribute(x: Column) -> Column:
    return F.replace(F.replace(escape_field(x), F.lit('"'), F.lit("&quot;")), F.lit("\t"), F.lit("{TAB}"))


def unescape(x: Column) -> Column:
    """The five entities; the ampersand last, so that nothing is unescaped twice."""
    for entity, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(ch))
    return x


#: Characters that an index can't hold, in the order of their stand-ins from U+007F on.
SPECIAL = " /<>|"


def encode_special(x: Column, keep: str = "", prefix: str = "", first: int = 0x7F) -> Column:
    """Special characters become code points from ``first`` on, behind ``prefix``. keep: those left alone, as ``|`` in sets."""
    for i, ch in enumerate(SPECIAL):
        if ch not in keep:
            x = F.replace(x, F.lit(ch), F.lit(prefix + chr(first + i)))
    return x


def decode_special(x: Column, prefix: str = "", first: int = 0x7F) -> Column:
    for i, ch in enumerate(SPECIAL):
        x = F.replace(x, F.lit(prefix + chr(first + i)), F.lit(ch))
    return x


# -- sets: |a|b|, empty |


def set_items(x: Column) -> Column:
    return F.filter(F.split(x, "[|]"), lambda v: v != "")


def set_value(items: Column) -> Column:
    return F.when(F.size(items) == 0, "|").otherwise(F.concat(F.lit("|"), F.array_join(items, "|"), F.lit("|")))


def set_union(*values: Column) -> Column:
    return set_value(F.array_sort(F.array_distinct(F.flatten(F.array(*map(set_items, values))))))


def set_weights(x: Column) -> Column:
    """|value:number|...| as a map; a value without a number weighs 1."""
    entry = lambda v: F.struct(F.regexp_replace(v, r":[0-9]+$", ""), F.coalesce(F.regexp_extract(v, r":([0-9]+)$", 1).try_cast("long"), F.lit(1)))
    return F.map_from_entries(F.transform(set_items(x), entry))


def duplicates(items: Column) -> Column:
    """Values that occur more than once, in the order of their first places."""
    return F.filter(F.array_distinct(items), lambda v: F.size(F.filter(items, lambda w: w == v)) > 1)


# -- repairs


def collapse_spaces(x: Column) -> Column:
    """U+0020 only."""
    return F.regexp_replace(F.trim(x), " +", " ")


def drop_soft_hyphens(x: Column) -> Column:
    return F.regexp_replace(x, r"\x{00AD}+", "")


def join_line_hyphens(x: Column) -> Column:
    """A word cut at a line end is joined; its hyphen stays between equal vowels. Lines of a page number alone go."""
    x = F.regexp_replace(x, r"(?m)^[ \t]*[0-9]+[ \t]*\n", "")
    x = F.regexp_replace(x, r"(?i)([aeiouyäöå])-[ \t]*\n[ \t]*(?=\1)", "$1-")
    return F.regexp_replace(x, r"(\p{L})-[ \t]*\n[ \t]*(?=\p{L})", "$1")


def substitute(x: Column, pattern: str, by: str, flags: str = "") -> Column:
    """s/pattern/by/flags: the first match, with g all; i without case, x with blanks and comments. Groups are $1 in ``by``."""
    inner = "".join(f for f in flags if f in "ixms")
    pattern = f"(?{inner}:{pattern})" if inner else f"(?:{pattern})"
    if "g" in flags:
        return F.regexp_replace(x, pattern, by)
    # what precedes the first match is a group of its own, so groups in ``by`` move up by one
    moved = re.sub(r"[$]([0-9])", lambda m: f"${int(m[1]) + 1}", by)
    return F.regexp_replace(x, f"^((?s:.*?)){pattern}", "$1" + moved)


SLICE = 1 << 18  #: characters that a value function holds as Python strings


def sliced(function: Callable[[str], str], values: pa.Array) -> Iterator[pa.Array]:
    """The function of each value; null stays null. Only a slice of the batch is Python strings at a time."""
    part, size = [], 0
    for x in values:
        value = x.as_py()
        part.append(None if value is None else function(value))
        size += len(value or "")
        if size > SLICE:
            yield pa.array(part, pa.string())
            part, size = [], 0
    yield pa.array(part, pa.string())


def _value_function(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """A function of one string over Arrow batches; null stays null."""

    def apply(x: Column) -> Column:
        def batches(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for b in values:
                yield from sliced(function, b)

        return F.arrow_udf(batches, "string")(x)

    return apply


def _from_mojibake(v: str) -> str:
    for codec in ("cp1252", "latin-1") if not v.isascii() else ():
        try:
            return v.encode(codec).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
    return v


class _Stripped(dict):
    """What a character of a composed string becomes, worked out when it is first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = c if c in "åäöÅÄÖ" else "".join(d for d in unicodedata.normalize("NFKD", c) if not unicodedata.combining(d))
        return self[code]


_stripped = _Stripped()


def _strip_marks(v: str) -> str:
    return v if v.isascii() else unicodedata.normalize("NFC", v).translate(_stripped)


def repair_mojibake(x: Column) -> Column:
    """UTF-8 that was read as Windows-1252 or Latin-1, where the whole value reads back."""
    return _value_function(_from_mojibake)(x)


def without_diacritics(x: Column) -> Column:
    """Decomposed, without combining marks, but for the letters of the Finnish and Swedish alphabets."""
    return _value_function(_strip_marks)(x)


#: Kinds of characters that checks look for, as patterns.
CHARACTER_KINDS = {
    "control": r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]",
    "private": r"[\x{E000}-\x{F8FF}]",
    "noncharacter": r"[\x{FDD0}-\x{FDEF}\x{FFFE}\x{FFFF}]",
    "bidi": r"[\x{061C}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2066}-\x{2069}]",
    "shy": r"\x{00AD}",
    "tag": r"[<>]",
}


def repair_characters(x: Column) -> Column:
    """Control, private and non-characters go; entities that were escaped twice are escaped once."""
    for kind in ("control", "private", "noncharacter"):
        x = F.regexp_replace(x, CHARACTER_KINDS[kind], "")
    return F.regexp_replace(x, r"&amp;(lt|gt|quot|apos|amp);", "&$1;")


# -- lemmas and words


def lemma_without_boundaries(x: Column, mark: str = "|", word: Column | None = None) -> Column:
    """A compound's lemma without the marks between its parts; a mark that is all of it stays.

    With the word form, marks that stand for its hyphens become hyphens: all of them where both have as many parts, else
    before each part that begins (by two letters) like the word's next part, about as far from the start. A mark at an end
    becomes a hyphen if the word has one there. A word with marks of its own keeps its lemma. Null where either is null.
    """
    bare = F.replace(x, F.lit(mark), F.lit(""))
    if word is None:
        return F.when(bare == "", x).otherwise(bare)
    size, dash, bar = F.length(x), F.lit("-"), F.lit(mark)
    inner = F.contains(F.substring(x, F.lit(2), F.greatest(size - 2, F.lit(0))), bar)
    end = lambda at_end, hyphen: F.when(at_end & hyphen, "-").otherwise("")
    cut = F.when(F.startswith(x, bar), F.substring(x, F.lit(2), size)).otherwise(x)
    cut = F.when(F.endswith(x, bar), F.substring(cut, F.lit(1), F.length(cut) - 1)).otherwise(cut)
    edged = F.concat(end(F.startswith(x, bar), F.startswith(word, dash)), cut, end(F.endswith(x, bar), F.endswith(word, dash)))
    lemma = F.when(inner, x).otherwise(edged)
    parts, heard = F.split(lemma, f"[{re.escape(mark)}-]"), F.split(word, "-")

    def add(s: Column, part: Column) -> Column:
        next_ = F.get(heard, s["next"])
        hit = F.coalesce((F.substring(part, 1, 2) == F.substring(next_, 1, 2)) & (F.abs(s["heard"] - s["read"]) <= 2), F.lit(False))
        step = hit.cast("int")
        return F.struct(F.concat(s["out"], F.when(hit, "-").otherwise(""), part).alias("out"), (s["read"] + F.length(part)).alias("read"), (s["heard"] + F.coalesce(F.length(next_), F.lit(0)) * step).alias("heard"), (s["next"] + step).alias("next"))

    start = F.struct(parts[0].alias("out"), F.length(parts[0]).alias("read"), F.length(heard[0]).alias("heard"), F.lit(1).alias("next"))
    folded = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), start, add, lambda s: s["out"])
    same = (F.size(parts) == F.size(heard)) & ~F.contains(lemma, dash)
    told = F.when(inner & ~F.contains(word, dash), bare).when(same, F.replace(lemma, bar, dash)).otherwise(folded)
    if mark == "#":  # some parsers write the marks of a word of marks so
        pipes = F.length(word) - F.length(F.replace(word, F.lit("|"), F.lit("")))
        told = F.when(size - F.length(bare) == pipes, F.replace(x, bar, F.lit("|"))).otherwise(told)
    alone = (size == 1) | (x == mark * 2)
    if mark == "#":
        alone = alone & (size - F.length(bare) != pipes)
    return F.when(word.isNull(), None).when(~F.contains(x, bar) | F.contains(word, bar) | alone, x).otherwise(told)


def lemgram(lemma: Column, pos: Column, longest: int = 100) -> Column:
    """lemma..pos.1; beyond ``longest`` characters the lemma is cut and the end stays."""
    end = F.concat(F.lit(".."), pos, F.lit(".1"))
    return F.concat(F.substring(lemma, F.lit(1), F.greatest(F.lit(0), F.lit(longest) - F.length(end))), end)


def mapped(x: Column, mapping: Mapping[str, str], default: str) -> Column:
    """A small fixed mapping, such as of parts of speech."""
    if not mapping:
        return F.lit(default)
    return F.coalesce(F.create_map(*(F.lit(v) for pair in mapping.items() for v in pair))[x], F.lit(default))


def name_case(base: Column, last: Column) -> Column:
    """A name's base form in the case of its last word form: upper where that is upper, else each word with a capital."""
    return F.when((F.upper(last) == last) & (F.length(last) > 1) & (F.lower(last) != last), F.upper(base)).otherwise(F.initcap(base))


def padded(x: Column, width: int, fill: str = "0") -> Column:
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, fill))


def redact_long(x: Column, longest: int, kind: str = "any", prefix: str = "[", text: str = "redacted", suffix: str = "]", octets: bool = False) -> Column:
    """Values of ``longest`` characters (or bytes) or more, of a kind (word, link, other, any), are replaced."""
    size = F.octet_length(x) if octets else F.length(x)
    link = F.rlike(x, F.lit(r"^(?:https?://|www\.)"))
    word = F.rlike(x, F.lit(r"^[\p{L}\p{M}\p{N}'’-]+$"))
    like = {"any": F.lit(True), "link": link, "word": word & ~link, "other": ~word & ~link}[kind]
    return F.when((size >= longest) & like, F.lit(prefix + text + suffix)).otherwise(x)


# -- dates and durations


def date_parts(ts: Column) -> dict[str, Column]:
    """datefrom, dateto, timefrom, timeto of an instant, as digits."""
    day, clock = F.date_format(ts, "yyyyMMdd"), F.date_format(ts, "HHmmss")
    return {"datefrom": day, "dateto": day, "timefrom": clock, "timeto": clock}


def first_instant(digits: Column) -> Column:
    """YYYY to YYYYMMDDhhmmss, filled up to its first second."""
    return F.concat(digits, F.substring(F.lit("00000101000000"), F.length(digits) + 1, F.lit(14)))


def last_instant(digits: Column) -> Column:
    """Filled up to its last second; months have their true lengths."""
    n = F.length(digits)
    month = F.when(n == 4, F.concat(digits, F.lit("12"))).otherwise(F.substring(digits, 1, 6))
    day = F.when(n <= 6, F.date_format(F.last_day(F.to_date(month, "yyyyMM")), "yyyyMMdd")).otherwise(F.substring(digits, 1, 8))
    return F.concat(day, F.when(n > 8, F.substring(digits, 9, 6)).otherwise(F.lit("")), F.substring(F.lit("235959"), F.greatest(n - 7, F.lit(1)), F.lit(6)))


def publication_year(*sources: Column) -> Column:
    """The first year of four digits (1000 to 2099) in the sources, in turn; else 0000."""
    return F.coalesce(*(F.nullif(F.regexp_extract(s, r"(?<![0-9])(1[0-9]{3}|20[0-9]{2})(?![0-9])", 1), F.lit("")) for s in sources), F.lit("0000"))


def full_year(two: Column, pivot: int = 30) -> Column:
    """Two digits to a year of 19xx or, below the pivot, 20xx."""
    n = two.try_cast("int")
    return F.when(n < pivot, 2000 + n).otherwise(1900 + n)


#: Patterns of the parts of dates, of those in which zeros must stand in front, of what parts them and what is between two dates.
DATE_PARTS = {"y": r"(?:1[0-9]|20)[0-9][0-9]|0?[0-9]?[0-9]?[0-9]", "m": r"1[0-2]|0?[1-9]", "d": r"[12][0-9]|3[01]|0?[1-9]"}
PADDED_PARTS = {"y": r"(?:1[0-9]|20)[0-9][0-9]|0[0-9][0-9][0-9]", "m": r"1[0-2]|0[1-9]", "d": r"[12][0-9]|3[01]|0[1-9]"}
SHORT_YEAR = r"(?:[01][0-9]|20)?[0-9][0-9]"
PART_SEPARATOR, RANGE_SEPARATOR = r"[-./]", r"\s*[-/–]\s*"


def date_span(x: Column, order: str = "ymd", full: bool = True, ranges: bool = True, short_years: bool = False, pivot: int = 30, newest: int = 2100) -> Column:
    """The first date or range of dates in a text, as digits: a struct of start and end, empty where there is none.

    ``order`` tells how year, month and day follow each other. In ``ymd`` month and day may be missing and parts need not
    be parted, but have zeros in front. Without ``full`` only years are looked for. What an end lacks is taken from the
    start. With ``short_years``, two digits are a year of 20xx, beyond the pivot of 19xx. Years beyond ``newest`` give
    nothing.
    """
    parts = dict(PADDED_PARTS if full and order == "ymd" else DATE_PARTS)
    if short_years:
        parts["y"] = SHORT_YEAR
    group = {c: f"({p})" for c, p in parts.items()}
    if not full:
        one, names = group["y"], "y"
    elif order == "ymd":
        between = f"(?:{PART_SEPARATOR})?"
        one, names = f"{group['y']}(?:{between}{group['m']}(?:{between}{group['d']})?)?", "ymd"
    else:
        one, names = PART_SEPARATOR.join(group[c] for c in order), order
    pattern = f"{one}(?:{RANGE_SEPARATOR}{one})?" if ranges else one
    values = F.array(*(F.regexp_extract(x, pattern, i + 1) for i in range(len(names) * (2 if ranges else 1))))

    def shown(of: dict[str, Column]) -> Column:
        year = of["y"]
        if short_years:
            year = F.when(F.length(year) == 2, F.concat(F.when(year.try_cast("int") > pivot, "19").otherwise("20"), year)).otherwise(year)
        if not full:
            return year
        digits = F.concat(padded(year, 4), F.when(of["m"] == "", "").otherwise(padded(of["m"], 2)), F.when(of["d"] == "", "").otherwise(padded(of["d"], 2)))
        return F.when((of["y"] == "") | (year.try_cast("int") > newest), "").otherwise(digits)

    def span(v: Column) -> Column:
        part = lambda c, k: F.get(v, F.lit(names.index(c) + k * len(names))) if c in names else F.lit("")
        start = {c: part(c, 0) for c in "ymd"}
        if not ranges:
            return F.struct(shown(start).alias("start"), F.lit("").alias("end"))
        given = {c: part(c, 1) for c in "ymd"}
        there = F.concat(*given.values()) != ""
        end = {c: F.when(there & (g == ""), start[c]).otherwise(g) for c, g in given.items()}
        return F.struct(shown(start).alias("start"), shown(end).alias("end"))

    return F.get(F.transform(F.array(values), span), F.lit(0))  # bound once, not repeated in each place


def whole_days(span: Column) -> Column:
    """A span of ``date_span`` filled up to its first and last day (YYYYMMDD); a single date ends where it began."""
    last = F.when(span["end"] == "", span["start"]).otherwise(span["end"])
    return F.struct(F.when(span["start"] == "", "").otherwise(F.substring(first_instant(span["start"]), 1, 8)).alias("start"), F.when(last == "", "").otherwise(F.substring(last_instant(last), 1, 8)).alias("end"))


def duration_seconds(x: Column) -> Column:
    """[[[D-]HH:]MM:]SS[.f] as seconds."""
    part = lambda i: F.coalesce(F.regexp_extract(x, r"^(?:(?:(?:([0-9]+)-)?([0-9]+):)?([0-9]+):)?([0-9]+(?:\.[0-9]+)?)$", i).try_cast("double"), F.lit(0.0))
    return part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)


def duration_text(seconds: Column) -> Column:
    """[[D-]HH:]MM:SS of a number of seconds, without leading parts of zero."""
    n = F.floor(seconds).cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    day, hour, minute = F.floor(n / 86400).cast("long"), F.floor(n % 86400 / 3600).cast("long"), F.floor(n % 3600 / 60).cast("long")
    clock = F.concat(two(minute), F.lit(":"), two(n % 60))
    return F.concat(F.when(day > 0, F.concat(day.cast("string"), F.lit("-"))).otherwise(""), F.when(n >= 3600, F.concat(two(hour), F.lit(":"))).otherwise(""), clock)


#: Finnish month names, in order.
FINNISH_MONTHS = "tammikuu helmikuu maaliskuu huhtikuu toukokuu kesäkuu heinäkuu elokuu syyskuu lokakuu marraskuu joulukuu".split()


def finnish_month(x: Column) -> Column:
    """The number of a month named in any case form; null for other words."""
    return F.coalesce(*(F.when(F.startswith(F.lower(x), F.lit(m)), i) for i, m in enumerate(FINNISH_MONTHS, 1)))


# -- tags


def start_tag(name: str, attributes: Column, in_order: bool = False) -> Column:
    """attributes: a map. Missing ones are left out."""
    entries = F.map_entries(attributes)
    entries = F.array_sort(entries) if in_order else entries
    shown = F.transform(entries, lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), escape_attribute(e["value"]), F.lit('"')))
    return F.concat(F.lit("<" + name), F.coalesce(F.array_join(shown, ""), F.lit("")), F.lit(">"))


def tag_attributes(line: Column) -> Column:
    """The attributes of a start tag, as a map; the last of equal names wins."""
    found = F.regexp_extract_all(line, F.lit(r'([\w.-]+="[^"]*")'), F.lit(1))
    pairs = F.transform(found, lambda a: F.struct(F.substring_index(a, "=", 1).alias("key"), unescape(F.regexp_extract(a, r'="([^"]*)"', 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)
