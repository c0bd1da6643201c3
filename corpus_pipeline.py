"""Documents to training tokens: filter, dedupe, decontaminate, mix, encode.

Each stage takes the documents that its predecessor kept and returns those it
keeps, with the columns of documents; the last one returns the place of every
document in the token files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.llm import decontaminate, minhash, mixing, token_files, toxicity
from vacanta.llm.common import park, read

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labels, does not find toxic."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    name = "toxic_" + "_".join(docs.columns)  # no column of documents has it
    return toxicity.score(docs, model, name).where(F.col(name) < TOXIC_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, 80 per cent alike."""
    return minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's target weight takes it."""
    mixture = mixing.mix(docs, whole=True)
    return mixing.mixed_rows(docs, mixture).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows; their documents' places and checksums, read back."""
    return token_files.read_tokens(spark, token_files.write_tokens(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# The classifier, the links and the ids have no SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = park(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
