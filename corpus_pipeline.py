"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents, others than the usual ones included, whatever their names; the last returns what is read back from the token records.

Odd rows. NULL texts count as empty: they are scored, share the fingerprint of empty texts (so one of them stays), hold no benchmark, have no
tokens in the mix, and give a record with the end id alone. Rows with a NULL id are never learnt from, stay after a near copy with an
id only if they are none, and come first in the records. Repeated rows are near copies of each other. Texts of any length are worked on
whole. Tables without rows give no rows. The stages read their input twice, which the tables written between them allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, quality, records, simhash
from millrace.llm.common import table
from millrace.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Without labels of both classes all or none go, by the share of good ones."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; of equal smallest ids one row."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go; all others stay as they are. Items without words hold nothing."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per epoch that the budget of their leaf reaches. NULL languages and sources are leaves of their own."""
    return mixing.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, written and read back: one per row, in order of the id."""
    return records.token_records(docs)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

# hashes of shingles, trained weights and token ids are beyond SQL; the tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
