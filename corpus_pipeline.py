"""A corpus pipeline: language, toxicity, near duplicates, mixing, tokens.

Every stage works on what its predecessor kept, is written as Parquet to the
shared folder and read again. All but the last return the columns of
`documents`; each rejects or repeats rows by the decision of one operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harborline.llm.common import prepare_llm, stored
from harborline.llm.stages import language, mixture, near_duplicates, tokens, toxicity

STAGES = [
    ("language_id", language),
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]

#: Classifiers, a fitted mixture and a tokenizer aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on the documents of a folder."""
    docs = prepare_llm(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
