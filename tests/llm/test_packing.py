import zlib

import numpy as np
import pytest
from tests.llm import cases

from spanloom.llm import packing, queries

P = queries.tokenizer_path()


def test_tournament_is_first_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 500)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room = [100] * 500
    for i in np.argsort(-lengths, kind="stable"):
        want = next(b for b in range(500) if room[b] >= lengths[i])
        assert (bins[i], offsets[i]) == (want, 100 - room[want])
        room[want] -= lengths[i]


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    plain, memo = Tokenizer.from_file(P), packing.Tokens(P)
    texts = [t for _, t in cases.awkward() if t is not None]
    texts += ["It's  the dog's  'tis\r\n\x1c!\x1c! <|endoftext|> x<|startoftext|>", "é Σας ΣΑΣ İ ǅ 3½ 一二", "a b\x85c᠎d !?!\t!?"]
    for t, got in zip(texts, memo(texts), strict=True):
        assert got == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t[:50]


def test_parts_and_forgetting(monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    monkeypatch.setattr(packing, "MEMO", 100)
    test_tokens_equal_the_tokenizer()


@pytest.mark.parametrize("group_docs", [4, 4096])
def test_pack(spark, group_docs):
    rows = cases.awkward() + [(i, cases.prose(i, i % 700)) for i in range(100, 180)]
    docs = cases.documents(spark, rows)
    got = packing.pack(docs, P, group_docs=group_docs).toPandas()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P)
    ids = [(i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t in rows]
    want = sorted((str(i), s, len(x[s : s + 2048]), zlib.crc32(x[s : s + 2048].tobytes()), len(x)) for i, x in ids for s in range(0, len(x), 2048))
    have = sorted((str(None if d != d else int(d)), s, n, c, t) for d, s, n, c, t in got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False))
    assert have == want
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"] == seq["length"].cumsum() - seq["length"]).all() and seq["length"].sum() <= 2048
    if group_docs > 100:
        assert got["length"].sum() / (2048 * got["sequence_id"].nunique()) > 0.9


def test_empty(spark):
    assert packing.pack(cases.documents(spark, []), P).count() == 0


def test_only_distinct_stretches_are_looked_up(monkeypatch):
    """A word that a group of texts repeats is one string and one look-up; ids stay those of the tokenizer."""
    seen = []
    fill = packing.Tokens.fill

    class Counted(dict):
        def __getitem__(self, x):
            seen.append(x)
            return super().__getitem__(x)

    def filled(self, stretches):
        fill(self, stretches)
        self.memo = Counted(self.memo)

    tokens = packing.Tokens(P)
    monkeypatch.setattr(packing.Tokens, "fill", filled)
    texts = ["one two, One\ttwo, two! " * 500, "", "two, İx İx."]
    got = list(tokens(texts))
    assert len(seen) < 20
    assert got == [np.array(tokens.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
