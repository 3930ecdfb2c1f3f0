"""The corpus pipeline: documents through a fixed row of stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before
kept, and returns a DataFrame, which is written as Parquet and read again as
the next one's documents. All but the last return the columns of documents;
columns of any other name are handed on, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm import decontaminate, near_dedup, sentencepiece_lattice, substring_dedup, toxicity
from moraine.llm.common import lean, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; null, empty and wordless texts get the share of toxic labels, and stay."""
    lean(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by id) of each group of near duplicates at a similarity of 0.8; rows without an id or without words stay."""
    lean(spark)
    return near_dedup.one_of_each(docs, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words covered by windows that also start earlier; ``n_chars`` is counted anew (null texts stay null)."""
    lean(spark)
    cut = substring_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark, row by row, whatever their ids."""
    lean(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, lossless`` for every document left; null and empty texts have no ids."""
    lean(spark)
    return sentencepiece_lattice.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

#: The toxicity network and the piece lattice can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
