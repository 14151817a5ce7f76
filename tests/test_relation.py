"""Laws of the relation algebra on small relations."""

import pytest
from pyspark.sql import functions as F

from spanloom.operators.relation import BadData, Relation, names_of, numbered
from spanloom.sources import tsv


@pytest.fixture(scope="module")
def rel(spark):
    def make(head, rows):
        return Relation(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in head)))

    class R:
        note = make(["note", "id"], [("do", "1"), ("re", "2"), ("mi", "3"), ("do", "8")])
        word = make(["word", "id"], [("yksi", "1"), ("kaksi", "2"), ("öö", "9")])
        few = make(["word", "mean"], [("a", "x"), ("b", "y")])
        more = make(["mean", "word"], [("x", "a"), ("y", "b"), ("z", "c")])
        apart = make(["word", "mean"], [("q", "x")])
        dee, dum = Relation.dee(spark), Relation.dum(spark)

    return R


def rows(r):
    return sorted(tuple(r.df.select(*sorted(r.names)).collect()))


def same(a, b):
    return a.cmp(b) == "eq"


def test_names():
    assert names_of("a, b c", ["d"]) == ["a", "b", "c", "d"]


def test_dee_and_dum(rel):
    r = rel.note
    assert same(r.join(rel.dee), r) and same(r.match(rel.dee), r) and same(r.miss(rel.dum), r)
    assert r.match(rel.dum).df.count() == 0 and r.join(rel.dum).df.count() == 0 and r.miss(rel.dee).df.count() == 0
    assert r.keep().df.count() == 1 and r.filter("id = 'none'").keep().df.count() == 0
    assert r.image(r).df.count() == 1 and r.image(r).names == []


def test_joins(rel):
    joined = rel.note.join(rel.word)
    assert joined.names == ["note", "id", "word"] and joined.df.count() == 2
    assert same(rel.note.compose(rel.word), joined.drop("id"))
    assert same(rel.note.match(rel.word), joined.keep("note id"))
    assert same(rel.note.match(rel.word).union(rel.note.miss(rel.word)), rel.note)
    assert same(rel.note.image(rel.word), rel.note.match(rel.word).drop("id"))


def test_sets(rel):
    a, b, c = rel.few, rel.more, rel.apart
    assert a.cmp(b) == "lt" and b.cmp(a) == "gt" and a.cmp(c) == "ne" and a.cmp(a) == "eq"
    for r in (a, b, c):
        assert r.cmp(a.union(b, c)) in ("lt", "eq")
    assert same(a.meet(b), a) and b.sans(a).df.count() == 1 and a.sans(b).df.count() == 0
    assert same(a.symm(c), a.union(c)) and a.symm(a).df.count() == 0
    assert sorted(r["tag"] for r in a.sum(c).df.collect()) == ["1", "1", "2"]
    with pytest.raises(BadData):
        a.union(rel.note)


def test_projection(rel):
    assert rel.note.keep("note").df.count() == 3
    assert {tuple(r) for r in rel.note.keepc("note", "n").df.collect()} == {("do", 2), ("re", 1), ("mi", 1)}
    assert rel.note.rename({"note": "id", "id": "note"}).names == ["id", "note"]
    assert rel.note.order("id").names == ["id", "note"]
    for bad in (lambda: rel.note.keep("nix"), lambda: rel.note.keepc("note", "note"), lambda: rel.note.rename({"note": "id"}), lambda: rel.note.extend(**{"id": "1"})):
        with pytest.raises(BadData):
            bad()


def test_order_and_samples(spark, rel):
    ids = lambda r: [x["id"] for x in r.sort("id").df.collect()]
    assert len(ids(rel.note.head(2))) == 2 and len(ids(rel.note.head(-1))) == 3 and len(ids(rel.note.tail(3))) == 3
    assert len(rows(rel.note.tail(3, start=True))) == 2
    assert rel.note.sample(100).df.count() == 4 and rel.note.sample(2, 1).cmp(rel.note) == "lt"
    assert rows(rel.note.sample(2, seed=4)) == rows(rel.note.sample(2, seed=4))
    nr = numbered(spark.range(1000).repartition(7), [F.desc("id")], "nr")
    assert sorted((r["nr"], r["id"]) for r in nr.collect()) == [(i, 1000 - i) for i in range(1, 1001)]


def test_text_round_trip(spark, rel, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text("word\tmean\nä\t\n\tx\nä\t\n", encoding="utf-8")
    r = tsv.read_relation(spark, str(path))
    assert rows(r) == [("", "ä"), ("x", "")]
    tsv.write_relation(r, str(tmp_path / "out"))
    assert same(tsv.read_parts(spark, str(tmp_path / "out")), r)
    (tmp_path / "h.txt").write_text("b\t1\na\t2\nb\t1\n")
    assert tsv.relation_from(spark, str(tmp_path / "h.txt"), {"v1": "k"}).df.count() == 2
    assert sorted(x["nr"] for x in tsv.relation_from(spark, str(tmp_path / "h.txt"), tag="nr").df.collect()) == ["1", "2", "3"]
    (tmp_path / "bad.tsv").write_text("a\tb\n1\n")
    with pytest.raises(Exception, match="2 fields"):
        tsv.read_relation(spark, str(tmp_path / "bad.tsv")).df.collect()
    (tmp_path / "dee.tsv").write_text("\n\n")
    assert tsv.read_relation(spark, str(tmp_path / "dee.tsv")).df.count() == 1
