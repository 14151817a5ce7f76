"""Joins whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 512  #: most parts that the rows of one key are dealt to
FEW = 100_000  #: most hot keys that are broadcast


def hot_join(rows: DataFrame, facts: DataFrame, keys: Sequence[str], count: str, held: int, few: int = FEW) -> DataFrame:
    """Inner join with ``facts``, which has few rows for each key and tells in ``count`` how many of ``rows`` have it.

    Keys of more than ``held`` rows are joined apart. There are at most rows / held of them: up to ``few``, which are
    counted, they are broadcast, and their rows are not shuffled at all. More are dealt over salts by a hash of all columns
    of their rows, with the facts about them repeated for each salt, so that no task gets more than about ``held`` rows of
    a key, or a ``PARTS``-th of the hottest key's rows. Both inputs are read twice, so they should be written tables.
    """
    keys = list(keys)
    most = facts.agg(F.max(count)).first()[0] or 0
    if most <= held:
        return rows.join(facts, keys)
    limit = max(held, -(-most // PARTS))
    hot, rest = facts.where(F.col(count) > limit), facts.where(F.col(count) <= limit)
    if few and hot.limit(few + 1).count() <= few:
        met = rows.join(F.broadcast(hot), keys)
        cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
        return met.unionByName(cold.join(rest, keys))
    salts = int(-(-most // limit))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    hot = hot.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = salted.join(hot, [*keys, "__salt"]).drop("__salt")
    cold = salted.join(hot.select(*keys, "__salt"), [*keys, "__salt"], "left_anti").drop("__salt")
    return met.unionByName(cold.join(rest, keys))
