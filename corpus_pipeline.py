"""A corpus pipeline: language ID, exact dedup, near-dedup, mixing, packing.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frameloom.llm import exact_dedup, language, mixing, near_dedup, packing
from frameloom.llm.util import TEXT_ROWS, table, write_table

#: Words that a packing worker remembers: it stays through the stages that follow, beside them.
PACKING_WORDS = 100_000
#: SQL can't express the language model, the fingerprints or the tokenizer.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter, or too uncertain, go.

    Null and empty texts have no language and go. Very long texts are scored whole, in parts. Of languages that tie the first in order is told; a document whose
    score is under a half goes. Rows that share an id are one document and stay or go together, repeated rows too. No row gives none. Columns of any name stay as they are.
    """
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of equal text, the one with the largest id.

    A null text counts as empty, so one of all null and empty ones stays. Texts are compared whole, however long. Of rows that tie in text and id, repeated ones too, one stays; a null id loses to
    all others. No row gives none. Columns of any name stay as they are.
    """
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Null and empty texts are near copies of each other, texts of fewer than five words only of texts of the same words. Texts are compared whole. Pairs of a similarity of exactly 0.8
    are near copies. Rows that share an id are one document; rows of a null id stay. No row gives none. Columns of any name stay as they are.
    """
    return near_dedup.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the parts and as often as the sources' weights ask for.

    Null and empty texts have no word and aren't taken. A very long text is taken in parts, as its blocks are drawn. A null source is one of its own, after all others. Rows that are alike in id, source
    and text stand for each other; their order has no meaning. No row gives none. Columns of any name stay; the text, and n_chars if there is one, are those of the part that is taken.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, with their ids, in sequences of at most 2048.

    Null and empty texts have the end's id alone. A text longer than a window is packed by itself. Of pieces with equal scores the longer document goes first, of equally long ones
    the earlier. Repeated rows are packed as often as they occur. No row gives none. Other columns, whatever their names, are not read. The pieces are written here, so that
    TEXT_ROWS texts at a time go to Python, whatever the caller's session has set.
    """
    return write_table(packing.pack(docs, packing.tokenizer_file(), cached_words=PACKING_WORDS), "packed", TEXT_ROWS)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
