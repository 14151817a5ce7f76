"""Relations as text: a head line of names, then a line of tab-separated values for each record.

All values are strings and an empty string is a value, so the CSV reader, which makes nulls of empty strings, isn't used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.relation import BadData, Relation, check_names, col, numbered


def _fields(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    parts = F.split("value", "\t", -1)
    if not names:
        bad = F.raise_error(F.lit("a record of a relation without fields isn't empty"))
        return lines.where(F.when(F.col("value") == "", True).otherwise(bad.cast("boolean"))).select()
    parts = F.when(F.size(parts) == len(names), parts).otherwise(F.raise_error(F.concat(F.lit(f"a record doesn't have {len(names)} fields: "), "value")).cast("array<string>"))
    return lines.select(*(F.element_at(parts, i).alias(n) for i, n in enumerate(names, 1)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, without a carriage return at its end; file and nr, the line's place in the file's part."""
    rows = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return rows.withColumn("nr", F.monotonically_increasing_id())


def read_relation(spark: SparkSession, path: str) -> Relation:
    """The head is read first; records that repeat count once."""
    lines = _lines(spark, path)
    head = lines.orderBy("file", "block", "nr").limit(1).collect()
    if not head:
        raise BadData(f"no head in {path}")
    names = head[0]["value"].split("\t") if head[0]["value"] else []
    check_names(names)
    body = lines.where(~((F.col("file") == head[0]["file"]) & (F.col("nr") == head[0]["nr"])))
    return Relation(_fields(body, names))


def relation_from(spark: SparkSession, path: str, mapping: Mapping[str, str] | None = None, tag: str | None = None) -> Relation:
    """Lines without a head. Fields are v1 to vK, renamed by ``mapping``; ``tag`` numbers the lines from 1, else those that repeat count once."""
    lines = _lines(spark, path)
    first = lines.orderBy("file", "block", "nr").limit(1).collect()
    k = len(first[0]["value"].split("\t")) if first and (first[0]["value"] or mapping) else 0
    names = [(mapping or {}).get(f"v{i}", f"v{i}") for i in range(1, k + 1)]
    check_names([*names, *([tag] if tag else [])])
    if not tag:
        return Relation(_fields(lines, names))
    lines = numbered(lines, [F.col("file"), F.col("block"), F.col("nr")], "__tag")
    parts = F.split("value", "\t", -1)
    return Relation(lines.select(*(F.element_at(parts, i).alias(n) for i, n in enumerate(names, 1)), F.col("__tag").cast("string").alias(tag)), distinct=False)


def write_relation(relation: Relation, path: str) -> None:
    """A folder with the head and the body as text tables, which ``read_parts`` reads. Nothing is overwritten."""
    names = relation.names
    body = relation.df.select(F.concat_ws("\t", *(F.coalesce(col(n).cast("string"), F.lit("")) for n in names)).alias("value")) if names else relation.df.select(F.lit("").alias("value"))
    spark = relation.df.sparkSession
    body.write.mode("errorifexists").text(f"{path}/body")
    spark.createDataFrame([("\t".join(names),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/head")


def read_parts(spark: SparkSession, path: str) -> Relation:
    """What ``write_relation`` wrote."""
    head = spark.read.text(f"{path}/head").first()["value"]
    return Relation(_fields(spark.read.text(f"{path}/body"), head.split("\t") if head else []), distinct=False)
