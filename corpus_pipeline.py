"""The corpus pipeline: quality rules, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``:

1. ``quality_rules``: documents that fail the base rules or the robust distance go.
2. ``line_dedup``: later copies of line runs of 50 words or more are deleted from the texts; documents of which nothing is left go.
3. ``near_duplicates``: of every group of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest id stays.
4. ``source_mix``: documents are repeated or left out until each source has its target of words.
5. ``packing``: pieces of at most 2048 tokens and their places in sequences.

``ORACLE_SQL`` is None: dependent rounding by hashes, the determinant and best-fit rounds are no SQL; the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm import jaccard, linededup, mixing, outliers, packing
from wardloom.llm.common import written
from wardloom.llm.queries import tokenizer_path

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and short texts fail the base rules and go; equal rows get the same verdict, each for itself; an empty table stays empty."""
    return outliers.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` is that of the new text."""
    found = linededup.dedup_lines(docs).where(~F.col("emptied"))
    changed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows alike in id and text one stays, of a group the smallest id, null ids last; texts without words have no near copies and stay; an empty
    table stays empty. Where a text is shared by a chain of links, the whole chain is one group."""
    return jaccard.one_of_each(docs, join=jaccard.Join(words=5, percent=80))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words weigh nothing and are taken by chance at their source's rate; equal rows are documents of their own; null sources are one source, the last; an empty table stays empty."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; a document that the mix repeats is packed as often."""
    packed = packing.pack(docs, tokenizer_path())
    digests = packed.pieces.select("row.doc_id", "piece", "start", "length", "task", "place", F.crc32("ids").alias("ids_crc32"))
    return packed.place(digests)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
