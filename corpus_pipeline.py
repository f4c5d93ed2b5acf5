"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last return the columns of `docs`, whatever
else they are named. An empty table gives no rows in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm import mixing, near_duplicates, ordinal_quality, packing, repeats
from gridweave.llm.common import table
from gridweave.llm.vocabulary import tokenizer_path
from gridweave.session import stage

#: Bytes of a repeated passage. Usual passages of over 50 words have as many; those of very short words, 101 at least, can have fewer and stay.
PASSAGE_BYTES, PASSAGE_GRAM = 200, 40


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on `labels`, takes for the best grade.

    A null text is judged as an empty one; null ids have no label but are judged; repeated rows are judged alike and all stay or go.
    """
    judged = ordinal_quality.judged(docs, table(spark, folder, "labels"))
    return judged.where("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, on five-word shingles and a similarity of 0.8: that with the smallest id.

    Null and empty texts are like nothing and all stay; of rows that repeat an id and a text one stays; a null id comes after all others.
    """
    return near_duplicates.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the passages that are there more than once; every row stays, if need be with an empty text.

    A null text stays null. Equal texts repeat each other, so both lose theirs (the stage before has left one of such).
    """
    return repeats.without_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix of sources to their targets; a document is a row as often as the mix takes it.

    A null source is a source of its own, rows without words take no part, and repeated rows are drawn each by itself.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all documents in training sequences, with their ids; a null or empty text is its end id alone, a null id stays null."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("source_mix", source_mix), ("packed", packed),
]
#: A fitted model, candidate search and a tokenizer are no SQL; tests check every stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what one stage returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
