"""From documents to packed training sequences, one corpus operator per stage.

Each stage reads all that its predecessor kept, as Parquet. All but the last return the
columns of documents, whatever these are.

Edge cases: null and empty texts and texts without letters go at the first stage, as they show
no language; with no training row every document does. Of equal texts the row with the
largest doc_id stays, of rows that repeat id and text one; a row without an id stays if no
other row has its text or a near copy. Very long texts are read whole. Columns of any other
name or content are handed on unread. An empty benchmark drops nothing, and an empty table
gives no rows.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import decontaminate, exact, language, near, packing
from tickwell.llm.common import fold, ship, stored, table
from tickwell.llm.queries import IN_HISTORY


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that show no language: no letter, or no n-gram of any language."""
    ship(spark)
    return language.identified(docs, ~fold(5, 0))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text, the largest doc_id."""
    ship(spark)
    return exact.survivors(docs, F.expr(IN_HISTORY))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash component, the smallest doc_id."""
    ship(spark)
    return near.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    ship(spark)
    return packing.pack(docs, packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]

#: SimHash, sampled n-gram filters and tokenizers have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
