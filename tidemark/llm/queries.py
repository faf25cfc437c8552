"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (
    divergence,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    licences,
    line_dedup,
    mixing,
    packing,
    pii,
    secrets,
    topk_search,
    warc_archive,
)
from tidemark.llm.shared import table


def _over(name: str, report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": _over("embeddings", topk_search.report),
    "op2_warc_archive": _over("pages", warc_archive.report),
    "op3_source_mixing": _over("documents", mixing.report),
    "op4_packing": _over("documents", packing.report),
    "op5_secret_scan": _over("documents", secrets.report),
    "op6_fingerprints": _over("documents", fingerprints.report),
    "op7_licence_scan": _over("documents", licences.report),
    "op8_ngram_jaccard_join": _over("documents", jaccard_join.report),
    "op9_language_id": _over("documents", language_id.report),
    "op10_pii": _over("documents", pii.report),
    "op11_hard_negatives": _over("embeddings", hard_negatives.report),
    "op12_line_dedup": _over("documents", line_dedup.report),
    "op13_source_divergence": _over("documents", divergence.report),
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_topk_search": topk_search.SQL,
    "op2_warc_archive": warc_archive.SQL,
    "op3_source_mixing": mixing.SQL,
    "op7_licence_scan": licences.SQL,
    "op8_ngram_jaccard_join": jaccard_join.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_line_dedup": line_dedup.SQL,
    "op13_source_divergence": divergence.SQL,
}
