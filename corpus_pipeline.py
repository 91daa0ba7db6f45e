"""From raw documents to packed training sequences, in stages that each write a table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. NULL and empty texts, repeated rows, empty tables and further columns are fine in every
stage; see the operators for the results they define.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.llm import base, jaccard_join, language_id, line_dedup, packing  # noqa: E402


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, without a letter or without a language that can be told go.

    The rule is the same for any number of languages; if no row is labelled, it is about letters only.
    """
    return language_id.with_known_language(docs, language_id.learn(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one; ``n_chars`` follows the text."""
    cleaned = line_dedup.clean(docs)
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept")).otherwise(F.col("row.n_chars")).cast(kind)
    return cleaned.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return jaccard_join.one_per_group(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", told_language),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", without_near_copies),
    ("packing", packed),
]

# Language ID, shingle hashes and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = base.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
