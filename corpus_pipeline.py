"""From raw documents to packed training sequences: five stages, each a corpus operator on all that its predecessor kept."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lookout.llm import minhash, mixing, packing, pii, quality  # noqa: E402
from lookout.llm.common import table  # noqa: E402
from lookout.llm.queries import tokenizer_path  # noqa: E402


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has changed; null stays null."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id; five words, similarity 0.8."""
    return minhash.deduplicated(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced by their kinds; every document stays."""
    return _counted(pii.sanitised(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight; a document is taken up to twice."""
    return _counted(mixing.mixed(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences without padding, one row per piece of a document."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("personal_data", remove_personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]
#: a trained classifier and a tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents`` on; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, _ = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
