"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, ball_kmeans, decontaminate, edit_prints, fm_index, lm_score, packing, simhash, suffix_dedup, token_counts, topk, toxicity, warc

MODULES = (alignment, ball_kmeans, decontaminate, edit_prints, fm_index, lm_score, packing, simhash, suffix_dedup, token_counts, topk, toxicity, warc)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run} | {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLE.items()}
