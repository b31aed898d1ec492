"""A training corpus from ``documents``: clean, unique, mixed, packed.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and gets all that the stage before it kept.  All but the last return the
columns of ``docs``; rows that a stage rejects go.  ``run`` applies them to
``documents``, each stage written as Parquet to the shared work folder and
reread, so that no stage is computed twice and none is lost with an executor.
Null and empty texts are clean, equal to each other, near to nothing, 0 words
to the mix (taken as often as their source is) and one end token to packing;
an empty table gives an empty corpus; extra columns are carried along up to
the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from provgraph.llm.common import Scratch
from provgraph.llm.exact_dedup import drop_exact_duplicates
from provgraph.llm.minhash import drop_near_duplicates
from provgraph.llm.mixing import mixed_documents
from provgraph.llm.packing import pack
from provgraph.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic passages reach the threshold go."""
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_exact_duplicates(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80% of their five-word shingles the one with the smallest id stays."""
    return drop_near_duplicates(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for."""
    return mixed_documents(docs, weights=(3, 1, 2), total=1.5, cap=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: MinHash, the toxicity model and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
