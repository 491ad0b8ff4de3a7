"""A corpus pipeline of five stages, each one operator of the training-data subpackage on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.llm import catalogue, line_dedup, packing, quality, simhash, substring_dedup
from afterglow.session import materialise, table


def _with_text(docs: DataFrame, found: DataFrame, text) -> DataFrame:
    """The columns of `docs` from `found`, with another text and its length."""
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return found.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go; documents without such a line keep their text."""
    found = line_dedup.drop_common_lines(docs, min_documents=10, min_chars=1)
    return _with_text(docs, found, F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, by shingles of five words."""
    return simhash.keep_one(docs, width=5, radius=5, bands=True)


def drop_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of 35 or more words that occur elsewhere go; documents without one keep their text, white space included."""
    found = substring_dedup.without_repeats(docs, window=35)
    return _with_text(docs, found, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(docs, catalogue.vocabulary("byte_bpe_50k.json"), size=2048, end_id=0)


STAGES = [("quality rules", quality_rules), ("line dedup", drop_lines), ("SimHash near-dedup", near_dedup), ("substring dedup", drop_spans), ("best-fit packing", pack)]

#: An isolation forest, fingerprints, components and packing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the shared checkpoint folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
