"""The training-data pipeline over ``documents``: STAGES, one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet below
``spark.checkpoint.dir`` and read again as the next stage's ``docs``. All stages but the last return
the columns of ``documents``. Each works on all that the stage before has kept and learns from it
anew; null, empty, repeated and extra-column rows are treated as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import langid, minhash, mixing, packing, pii
from quayside.llm.common import table, written
from quayside.session import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents without any letter go; ``lang`` becomes the predicted language."""
    ship_package(spark)
    return langid.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of every class of near-duplicates the document with the least id stays."""
    ship_package(spark)
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal data are masked; no document goes."""
    ship_package(spark)
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the mix of the sources at their target weights; a document is a row as often as
    the mix takes it."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the bucket and batch of every row of the mix."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("length_packing", length_packing),
]

#: The stages learn models and hash ids, which SQL does not express; tests hold them against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(spark, docs, f"stage-{name}")
    return docs
