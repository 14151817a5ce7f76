"""Small tables with the awkward rows that every operator has a defined result for."""

import random

BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int, words=BASE) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(n))


def documents(spark, rows, extra=True):
    """rows: (doc_id, text). Extra columns have names that operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    if extra:
        schema += ", id string, spans string, words int, key int, grp int, score string, start long"
        data = [(*r, "x", None, 1, None, 3, "s", None) for r in data]
    return spark.createDataFrame(data, schema)


def awkward():
    """Nulls, empties, blanks, exact and near copies, a repeated row, a very long text, other scripts."""
    long = prose(5, 30_000)
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, long), (8, "short one"), (9, "short one"),
        (10, prose(2, 80) + "\n" + prose(1, 120)), (None, base), (11, "İstanbul ſecret Ünïcödé 漢字 かな " + prose(3, 60)), (12, prose(3, 60)),
        (8, "short one"), (13, "a\x00b \x1c c d  e"), (14, "x" * 5000),
    ]
