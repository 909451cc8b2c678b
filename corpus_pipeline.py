"""From raw documents to packed training sequences: language, near duplicates, repeated passages, personal data, packing.

Each stage takes what its predecessor kept and returns the columns of documents; the last returns the pieces of the packed sequences.
Null or empty texts have no language and leave at the first stage. Further columns, whatever their names, come out as they went in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm import op2_substrings, op4_pii, op6_language, op9_packing, op10_minhash
from tidewell.session import settle

#: A text is rejected if no learned language holds this share of its letters.
LEAST_SHARE = 0.3
#: A text is rejected if its words speak against all learned languages by more than a change of language and back costs.
LEAST_FIT = -2 * op6_language.SWITCH


OWN = ("doc_id", "text")


def _boxed(docs: DataFrame) -> DataFrame:
    """doc_id and text, and all other columns as one struct, so that no result of an operator takes the place of one of them."""
    return docs.select(*OWN, F.struct(F.lit(True), *[F.col(f"`{c}`") for c in docs.columns if c not in OWN]).alias("rest"))


def _opened(made: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from a boxed frame; those named in ``new`` get new values, where docs has them."""
    kept = [new.get(c, F.col(c) if c in OWN else F.col("rest").getField(c)).alias(c) for c in docs.columns]
    return made.select(*kept)


def _with_text(docs: DataFrame, made: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with another text and its length."""
    return _opened(made, docs, text=text, n_chars=F.length(text).cast("bigint"))


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, with it as lang; a model of the labelled documents decides."""
    model = op6_language.learn(docs)
    found = op6_language.identify(_boxed(docs), model)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE) & (F.col("fit") >= LEAST_FIT))
    return _opened(kept, docs, lang=F.col("lang_pred"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    return op10_minhash.keep_one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 20 words that an earlier document holds; a text of which nothing is left goes."""
    made = op2_substrings.remove_repeats(_boxed(docs)).where("n_removed = 0 or kept_text <> ''")
    return _with_text(docs, made, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return _with_text(docs, op4_pii.mask(_boxed(docs)), F.col("masked"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts, each with its place in a sequence of 2048 tokens."""
    return op9_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The learned stages and the packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
