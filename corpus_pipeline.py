"""Documents to training sequences: five stages, each on all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns the rows that go on, stored as Parquet and read again. Rows keep
the columns of `documents` until the last stage, which returns where each piece of a document is packed. NULL texts
fail the quality rules, so later stages only see texts; empty tables pass through all stages.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import contamination, lines, near, packing, quality
from candlewick.llm.text import read_table
from candlewick.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_common_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packing.packed(parts.drop("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Packing in as few sequences as possible has no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows
