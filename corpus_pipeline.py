"""A corpus pipeline over the training-data operators: quality rules, near-duplicates, benchmark leaks, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return
the columns of documents. `run` applies them in order, with each stage's result staged as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import decontamination, mixing, packing, quality_rules, simhash_dedup
from ruleweave.llm.queries import table
from ruleweave.llm.stage import set_aside, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 3 words, at most 2 differing bits."""
    return simhash_dedup.one_of_each_group(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: shingles of 5 words, similarity of 0.8 or more."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights by the root of their size, copies included, in one global order."""
    docs, back, _ = set_aside(docs)
    mixed = mixing.mix(docs, alpha=0.5, epochs=1.0, seed=42, copy_col="_rw_copy_no", rate_col="_rw_source_rate")
    return back(mixed.drop("_rw_copy_no", "_rw_source_rate"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids."""
    return packing.pack(docs, row_tokens=2048)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontaminate), ("source_mixing", mix), ("token_packing", pack)]

#: SimHash, shingle similarity and tokens are beyond SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
