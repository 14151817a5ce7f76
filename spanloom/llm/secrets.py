"""Secret scans: keyword automaton first, anchored patterns only near its hits, checksums last.

* An Aho-Corasick automaton over all keywords passes once over each text; most texts end there.
* At each hit, one pattern is tried at exactly that place. Tried from left to right, behind the end of the kind's last
  match, this gives what a leftmost non-overlapping search over the whole text gives.
* Long hex runs have no keyword. Every eighth character is probed: a run of 32 holds four neighbouring probes. Only
  around such probes is the run itself measured.
* Kinds whose form embeds a checksum (``github``, ``npm``: a base-62 CRC-32 in the last six characters) are kept only
  if it holds.

Kinds: ``assign``, ``access``, ``hex``, then ``github``, ``npm``. Spans count code points, the end is exclusive.

Defined results: null and empty texts have no spans; rows are judged one by one, so repeated rows and ties repeat their
result; an empty table gives an empty table; other columns are ignored (``find``) or passed on (``redact``). Texts are taken
whole and one by one, so a task holds its Arrow batch and one text as a string, however long. There is no shuffle.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
#: Fixed values of the base kinds.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: Public token forms that end in a base-62 CRC-32 of the characters between prefix and checksum.
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",), "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_FOLD = {c: c + 32 for c in range(65, 91)}
_PROBE = re.compile(r"[0-9a-f]{4,}")


def checksum(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, keys in KEYWORDS.items():
        for key in keys:
            found.add_word(key, (kind, len(key)))
    found.make_automaton()
    return found


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for at in (7 + 8 * i for probes in _PROBE.finditer(text[7::8]) for i in range(*probes.span())):
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = HEX.match(text, start).end()
        if done - start >= MIN_HEX:
            yield start, done


def spans(text: str | None, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a text, by start, then kind."""
    if not text:
        return []
    folded = text.lower()
    if len(folded) != len(text):  # a few letters grow in lower case
        folded = text.translate(_FOLD)
    out = []
    done = dict.fromkeys(KINDS, 0)
    hits = [(last - n + 1, kind) for last, (kind, n) in keywords.iter(folded)]
    for start, kind in sorted(hits):
        if start < done[kind]:
            continue
        if kind == "assign" and (m := ASSIGN.match(text, start)):
            done[kind] = m.end()
            if len(m[2]) >= MIN_ASSIGN:
                out.append((kind, start, m.end()))
        elif kind == "access" and (m := ACCESS.match(text, start)):
            done[kind] = m.end()
            if m.end() - start >= MIN_ACCESS:
                out.append((kind, start, m.end()))
        elif kind in ("github", "npm") and (m := (GITHUB if kind == "github" else NPM).match(text, start)):
            done[kind] = m.end()
            if checksum(m[1]) == m[2]:
                out.append((kind, start, m.end()))
    out += [("hex", a, b) for a, b in _hex_runs(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end)."""
    ids = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = ids.schema["id"].dataType.simpleString()
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t.as_py(), keywords)] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, found)], ["id", "spans"])

    return ids.mapInArrow(scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; each maximal stretch of found spans is replaced by ``mark``."""
    at = docs.columns.index(text_col)

    def clean(text: str | None, keywords: ahocorasick.Automaton) -> str | None:
        found = spans(text, keywords)
        if not found:
            return text
        out, done = [], 0
        end = 0
        for _, s, e in found:
            if s >= end:
                out += [text[done:s], mark]
            end = done = max(end, e)
        return "".join([*out, text[done:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for b in batches:
            texts = pa.array([clean(t.as_py(), keywords) for t in b.column(at)], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return docs.mapInArrow(scan, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the contract, derived from ``find``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(1).to_pylist()
            base = [[s for s in row if s["kind"] in BASE_KINDS] for row in found]
            join = lambda row: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in row)
            counts = [pa.array([sum(s["kind"] == k for s in row) for row in base], pa.int64()) for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array([hashlib.sha256(join(row).encode()).hexdigest() for row in base]), pa.array([join(row) for row in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    found = find(docs)
    return found.mapInArrow(scan, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
