"""Relations: sets of records with named fields, on DataFrames.

A relation is a DataFrame without duplicate rows whose columns are found by name. Fields have no order that matters; the
order shown is kept for reading. There are two relations without fields: DEE with one empty record, DUM with none.

Duplicates are removed when a DataFrame becomes a relation (``distinct=True``), so set operations can count records.
Joins leave the choice of a strategy to Spark; set operations are one shuffle on all fields.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NAME = re.compile(r"[a-zA-Z_.][a-zA-Z0-9_.]*/?")


class BadData(ValueError):
    """A name is malformed, missing, or there already; or types differ."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def names_of(*lists: str | Sequence[str]) -> list[str]:
    """Names from lists, or from strings with commas or blanks between them."""
    return [n for x in lists for n in (re.split(r"[,\s]+", x.strip(", \t\n")) if isinstance(x, str) else x) if n]


def check_names(names: Sequence[str], head: Sequence[str] | None = None, new: bool = False) -> None:
    if bad := [n for n in names if not NAME.fullmatch(n)]:
        raise BadData(f"bad names: {bad}")
    if twice := sorted({n for n in names if list(names).count(n) > 1}):
        raise BadData(f"duplicate names: {twice}")
    if head is not None and (off := [n for n in names if (n in head) == new]):
        raise BadData(f"{'already' if new else 'not'} in head: {off}")


class Relation:
    def __init__(self, df: DataFrame, distinct: bool = True):
        check_names(df.columns)
        self.df = df.distinct() if distinct and df.columns else df.limit(1) if distinct else df

    # -- heads

    @property
    def names(self) -> list[str]:
        return self.df.columns

    @staticmethod
    def dee(spark: SparkSession) -> Relation:
        return Relation(spark.range(1).select(), distinct=False)

    @staticmethod
    def dum(spark: SparkSession) -> Relation:
        return Relation(spark.range(0).select(), distinct=False)

    def _like(self, df: DataFrame, distinct: bool = False) -> Relation:
        return Relation(df, distinct)

    def _shared(self, other: Relation) -> list[str]:
        return [n for n in self.names if n in other.names]

    # -- projection

    def keep(self, *fields: str | Sequence[str]) -> Relation:
        """The named fields in that order, without duplicates. No fields give DEE or DUM."""
        fields = names_of(*fields)
        check_names(fields, self.names)
        return self._like(self.df.select(*map(col, fields)), distinct=True)

    def drop(self, *fields: str | Sequence[str]) -> Relation:
        fields = names_of(*fields)
        check_names(fields, self.names)
        return self.keep([n for n in self.names if n not in fields])

    def keepc(self, fields: str | Sequence[str], count: str) -> Relation:
        """As ``keep``, with the number of records that became one."""
        fields = names_of(fields)
        check_names(fields, self.names)
        check_names([count], fields, new=True)
        found = self.df.groupBy(*map(col, fields)).agg(F.count("*").alias(count))
        return self._like(found.where(col(count) > 0))  # without fields, an empty relation has no group

    def dropc(self, fields: str | Sequence[str], count: str) -> Relation:
        fields = names_of(fields)
        check_names(fields, self.names)
        return self.keepc([n for n in self.names if n not in fields], count)

    def rename(self, mapping: Mapping[str, str]) -> Relation:
        """All at once, so names can be swapped. mapping: old to new."""
        check_names(list(mapping), self.names)
        after = [mapping.get(n, n) for n in self.names]
        check_names(after)
        return self._like(self.df.select(*(col(n).alias(m) for n, m in zip(self.names, after, strict=True))))

    def order(self, *fields: str | Sequence[str]) -> Relation:
        """The named fields first, the rest as they were."""
        fields = names_of(*fields)
        check_names(fields, self.names)
        return self._like(self.df.select(*map(col, [*fields, *(n for n in self.names if n not in fields)])))

    # -- extensions: what the reference announces as missing

    def extend(self, **new: Column | str) -> Relation:
        check_names(list(new), self.names, new=True)
        return self._like(self.df.select("*", *((F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in new.items())))

    def filter(self, condition: Column | str) -> Relation:
        return self._like(self.df.where(condition))

    def test(self, condition: Column | str) -> bool:
        """Whether all records meet the condition."""
        return self.df.where(~F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))).isEmpty()

    def info(self) -> DataFrame:
        """One row: number of records, and of distinct values by field."""
        return self.df.agg(F.count("*").alias("records"), *(F.countDistinct(col(n)).alias(n) for n in self.names))

    # -- joins

    def join(self, *others: Relation) -> Relation:
        """Natural join on all shared names, from left to right; a product where there are none."""
        return reduce(Relation._join, others, self)

    def _join(self, other: Relation) -> Relation:
        shared = self._shared(other)
        new = [n for n in other.names if n not in shared]
        if not shared:
            return self._like(self.df.crossJoin(other.df))  # a natural join without shared names is the product
        return self._like(self.df.join(other.df, shared, "inner").select(*map(col, [*self.names, *new])))

    def _half(self, other: Relation, how: str) -> DataFrame:
        shared = self._shared(other)
        if shared:
            return self.df.join(other.df.select(*map(col, shared)), shared, how).select(*map(col, self.names))
        return self.df.join(other.df.select(F.lit(1).alias("__one")).limit(1), F.lit(True), how)

    def match(self, other: Relation) -> Relation:
        """Records that match some record of the other on the shared names; without any, all if the other has records."""
        return self._like(self._half(other, "left_semi"))

    def miss(self, other: Relation) -> Relation:
        return self._like(self._half(other, "left_anti"))

    def image(self, other: Relation) -> Relation:
        """Matching records without the shared names."""
        return self.match(other).drop(self._shared(other))

    def compose(self, other: Relation) -> Relation:
        """Natural join without the shared names."""
        return self.join(other).drop(self._shared(other))

    # -- sets: all operands have the fields of the first, in any order

    def _tagged(self, others: Sequence[Relation], tag: str) -> DataFrame:
        for other in others:
            if sorted(other.names) != sorted(self.names):
                raise BadData(f"different types: {self.names} and {other.names}")
        parts = [r.df.select(*map(col, self.names), F.lit(str(i)).alias(tag)) for i, r in enumerate([self, *others], 1)]
        return reduce(DataFrame.unionByName, parts)

    def sum(self, *others: Relation, tag: str = "tag") -> Relation:
        """Disjoint union: each record with the number of its relation."""
        check_names([tag], self.names, new=True)
        return self._like(self._tagged(others, tag))

    def _grouped(self, others: Sequence[Relation]) -> DataFrame:
        return self._tagged(others, "__tag").groupBy(*map(col, self.names)).agg(F.count("*").alias("__n"), F.max("__tag").alias("__of"))

    def _chosen(self, found: DataFrame) -> Relation:
        return self._like(found.select(*map(col, self.names)))

    def union(self, *others: Relation) -> Relation:
        return self._chosen(self._grouped(others).where("__n > 0"))

    def meet(self, *others: Relation) -> Relation:
        """Records of all operands."""
        return self._chosen(self._grouped(others).where(F.col("__n") == 1 + len(others)))

    def sans(self, *others: Relation) -> Relation:
        """Records of the first operand only."""
        return self._chosen(self._grouped(others).where("__n = 1 AND __of = '1'"))

    def symm(self, *others: Relation) -> Relation:
        """Records of exactly one operand."""
        return self._chosen(self._grouped(others).where("__n = 1"))

    def compare(self, other: Relation) -> DataFrame:
        """One row: how many records are in the first only, in both, in the second only."""
        found = self._grouped([other])
        return found.agg(*(F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in (("only1", F.expr("__n = 1 AND __of = '1'")), ("both", F.expr("__n = 2")), ("only2", F.expr("__n = 1 AND __of = '2'")))))

    def cmp(self, other: Relation) -> str:
        """``eq``, ``lt`` (a proper part of the other), ``gt``, or ``ne``."""
        a, _, b = self.compare(other).first()
        return "eq" if not a and not b else "lt" if not a else "gt" if not b else "ne"

    # -- order and samples

    def sort(self, *fields: str | Sequence[str]) -> Relation:
        """By the named fields, or all; ties by the others, so that the order is total."""
        fields = names_of(*fields)
        check_names(fields, self.names)
        return self._like(self.df.orderBy(*map(col, [*fields, *(n for n in self.names if n not in fields)])))

    def _numbered(self, reverse: bool = False) -> DataFrame:
        """A number by the order of all fields, from ranges that are sorted apart, not in one task."""
        return numbered(self.df, [col(n).desc() if reverse else col(n) for n in self.names], "__nr")

    def head(self, n: int = 10) -> Relation:
        """The first n by the order of all fields; with n < 0 all but the last -n."""
        if n >= 0:
            return self._like(self.sort().df.limit(n))
        return self._like(self._numbered(reverse=True).where(F.col("__nr") > -n).drop("__nr"))

    def tail(self, n: int = 10, start: bool = False) -> Relation:
        """The last n, or with ``start`` those from the n-th on."""
        if start:
            return self._like(self._numbered().where(F.col("__nr") >= n).drop("__nr"))
        return self._like(self.df.orderBy(*(col(x).desc() for x in self.names)).limit(n))

    def sample(self, n: int = 30, seed: int = 0) -> Relation:
        """n records at random, by hash order: the same seed gives the same sample."""
        return self._like(self.df.orderBy(F.xxhash64(*map(col, self.names), F.lit(seed)), *map(col, self.names)).limit(n))

    def shuffle(self, seed: int = 0) -> Relation:
        return self._like(self.df.orderBy(F.xxhash64(*map(col, self.names), F.lit(seed)), *map(col, self.names)))


def running_sum(df: DataFrame, order: Sequence[Column], amount: Column, name: str) -> DataFrame:
    """Sums up to each row over the whole order, without sorting all rows in one task.

    Rows are dealt to ranges and summed within; each range then adds what the ranges before it hold. The ranges are as
    many as shuffle partitions, so their sums are a small table.
    """
    # lineage is cut so that sums within and before come from the same ranges
    from spanloom.session import Scratch

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    ranged = Scratch(df.sparkSession, "ranges").write(ranged)
    sums = ranged.groupBy("__range").agg(F.sum(amount).alias("__sum"))
    above = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = sums.select("__range", F.coalesce(F.sum("__sum").over(above), F.lit(0)).alias("__before"))
    within = F.sum(amount).over(Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.withColumn("__in", within).join(F.broadcast(before), "__range").withColumn(name, F.col("__in") + F.col("__before")).drop("__range", "__in", "__before")


def numbered(df: DataFrame, order: Sequence[Column], name: str, partition: Sequence[Column] = ()) -> DataFrame:
    """Running numbers from 1, within a partition or over the whole order by ranges."""
    if partition:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("long"))
    return running_sum(df, order, F.lit(1), name)
