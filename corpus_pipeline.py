"""A corpus for training, stage by stage: each stage's rows are written as Parquet and read again by the next one.

Columns may have any names, also clashing ones, and all but the last stage return those of their input; an empty table gives empty
ones throughout. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchantry.llm import line_dedup, mixing, near_dedup, pieces, toxicity
from merchantry.llm.rows import kept, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of this folder, rejects go; empty texts are scored as texts without a vote."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of three or more lines stay where they occur first. No row goes; rows of equal id and text fare alike."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays. Rows of equal id are one document; null ids and empty texts stay."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for, a null source being a source. Rows of equal id share one draw."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token count and the hashes of the ids and of the decoded text of every copy; an empty text has no tokens."""
    return pieces.tokenized_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("piece_encoding", tokenize),
]

# no SQL expresses the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
