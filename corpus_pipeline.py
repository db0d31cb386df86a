"""The training-data pipeline: five stages, each written as Parquet and read again by the next.

toxicity (rejected documents go), SimHash near-dedup (one document of each group stays), substring dedup
(repeated passages are cut), benchmark decontamination (leaked spans are cut, mostly leaked documents go) and
packing (pieces of power-of-two lengths). All stages but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvine.llm import decontaminate, fm_index, packing, simhash
from corvine.llm import toxicity as toxic
from corvine.llm._spark import Spool, fresh, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; a null text scores 0 and stays."""
    name = fresh("toxicity", docs)
    scored = toxic.score_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), into=name)
    return scored.where(F.col(f"{name}.score") < toxic.THRESHOLD).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one document, that with the smallest doc_id. Links: SimHash of five-word shingles within
    its radius, and sets of them with a Jaccard similarity of 0.8 or more."""
    return simhash.deduplicate(docs, size=5, least=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows."""
    return fm_index.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark spans; those mostly made of them go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The contract's digest of the packed pieces."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Not expressible in SQL: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`."""
    spool = Spool(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spool.keep(stage(spark, docs, sf_dir), name)
    return docs
