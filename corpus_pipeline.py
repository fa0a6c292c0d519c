"""From raw documents to packed training sequences; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.llm import language, mixing, packing, repeats, similar
from vidstrata.llm.common import free_name, held_out, small_batches
from vidstrata.session import tune, work_dir


# Languages that the corpus is to have, by the labels' names; None for all of them.
WANTED: tuple[str, ...] | None = None
# A document stays if its predicted language has at least this probability.
LEAST = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a wanted language (operator 4).

    A document goes if its text has no letter, if the language predicted is not in ``WANTED`` (None: all that the
    labels name), or if the model holds all languages together for likelier than the one predicted (``LEAST``).
    Without a labelled row no language is known, and only texts without a letter go.
    """
    tune(spark)
    small_batches(spark)
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    into = free_name(docs, "language")
    found = language.detect(docs, model, into=into)
    predicted, score = F.col(f"`{into}`.lang_pred"), F.col(f"`{into}`.score")
    kept = (predicted != language.UNDETERMINED) & (score >= LEAST)
    if WANTED is not None:
        kept &= predicted.isin(list(WANTED))
    if not model.families:
        kept = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.where(kept).select([f"`{c}`" for c in docs.columns])


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 2), that of the smallest doc_id."""
    tune(spark)
    return similar.one_of_each(docs).select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat elsewhere (operator 7); all documents stay."""
    tune(spark)
    return repeats.without_repeats(docs).select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them (operator 10)."""
    tune(spark)
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens (operator 9)."""
    tune(spark)
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("similar", one_of_similar),
    ("repeats", without_repeats),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# The stages learn, tokenize and round; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
