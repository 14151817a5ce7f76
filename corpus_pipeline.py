"""A corpus pipeline: documents go through five stages, each of which works on all that its predecessor kept.

1. ``toxicity``: documents that the model rejects go. It learns from labelled documents of the stage's own input.
2. ``near_dedup``: of each group of near-duplicates, the document with the smallest id stays.
3. ``decontamination``: documents that share a window of ten words with a benchmark item go.
4. ``secrets``: found secrets are replaced by a mark; documents stay.
5. ``packing``: documents become pieces of token sequences.

Stages with a learned model or a tokeniser have no SQL, so ``ORACLE_SQL`` is None; tests hold ``run`` against a
brute-force version.

Defined results: a null or empty text has no toxic word, no near-copy, no window and no secret, so its row goes through
to the last stage, where it is one piece of the end id alone. Rows with a null id are copies of nothing and stay.
Repeated rows share id and text: they stay or go together, and each is packed. Of near-copies, the smallest id stays, so
there are no ties. Texts are taken whole, however long; packing alone cuts them. Without labels of both kinds nothing is
toxic unless the base rate is; without benchmark items nothing is contaminated; without documents there are no rows.
Columns beyond those of ``documents`` go through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import decontamination, near_dedup, packing, secrets, toxicity
from spanloom.llm.queries import tokenizer_path
from spanloom.session import Scratch, table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), memo=200_000)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated), ("secrets", redact_secrets), ("packing", pack)]


#: Most bytes of texts in a batch that goes to a Python worker while stages run; one longer text is a batch of its own.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH[0])
    spark.conf.set(*BATCH)
    try:
        for _, stage in STAGES:
            docs = scratch.write(stage(spark, docs, sf_dir))
    finally:
        spark.conf.set(BATCH[0], before)
    return docs
