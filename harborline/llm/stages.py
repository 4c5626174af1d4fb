"""The stages of the corpus pipeline: (spark, documents, folder) -> DataFrame.

Each learns from what its predecessor kept (and the labels of the folder),
decides with one operator, and returns the documents that stay, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import language_id, minhash, mixing, sentencepiece
from harborline.llm import toxicity as toxic
from harborline.llm.common import table

#: A text stays if its language's filter knows this share of its n-grams; text of a learned language has 0.6 and more.
COVERAGE = 0.25
#: Shares of the kept tokens by quality label.
TARGETS = {"1": 0.95, "0": 0.05}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: not `und`, and enough of their n-grams known."""
    found = language_id.identify(docs, language_id.fit(docs))
    return found.where((F.col("made.lang_pred") != language_id.UNKNOWN) & (F.col("made.coverage") >= COVERAGE)).select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    return toxic.score(docs, model).where("made.score < 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id (five-word shingles, 0.8).

    Rows without a doc_id stay. Of rows that repeat a doc_id all stay or go.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says, so that quality labels get their shares of the tokens."""
    mixed = mixing.mix_to_targets(docs, table(spark, sf_dir, "labels"), TARGETS)
    return mixed.where("made.copies > 0").select("row", F.explode(F.expr("sequence(1, made.copies)")).alias("copy")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every document."""
    import public_tokenizers

    made = sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id", "lang", "source"])
    return made.select("row.*", "made.ids", F.size("made.ids").cast("long").alias("n_tokens"))
