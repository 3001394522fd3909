"""The corpus pipeline: language ID, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
docs of the next one. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame

from sheetwise.llm.jaccard import keep_one_of_each, near_duplicate_classes
from sheetwise.llm.language import accept_languages, learned
from sheetwise.llm.mixing import mix_documents
from sheetwise.llm.packing import pack_documents
from sheetwise.llm.shared import Scratch
from sheetwise.llm.substrings import remove_passages, repeated_passages


def identify_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, or without a language that holds half of their words."""
    return accept_languages(docs, learned(docs))


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class under five-word shingles and a similarity of 0.8 stays."""
    return keep_one_of_each(docs, near_duplicate_classes(docs, n=5, percent=80))


def drop_repeated_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay where they stand first; documents left without a word go."""
    return remove_passages(docs, repeated_passages(docs))


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix_documents(docs)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]
#: No stage can be written in SQL (models, hashing, random rounding and a tokenizer); the tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs, tables = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = tables.put(docs, str(k))
    return docs
