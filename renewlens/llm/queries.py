"""Registered queries and oracle SQL of the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from renewlens.llm import (
    bfd_pack,
    bm25_pack,
    containment,
    fertility,
    fuzzy_lines,
    host_consensus,
    language_id,
    nra_search,
    omh,
    range_shards,
    suffix_dedup,
    turn_trie,
    url_filter,
)

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_language_id": language_id.op2_language_id,
    "op3_bfd_packing": bfd_pack.op3_bfd_packing,
    "op4_retrieval_packing": bm25_pack.op4_retrieval_packing,
    "op5_tokenizer_fertility": fertility.op5_tokenizer_fertility,
    "op6_order_minhash": omh.op6_order_minhash,
    "op7_host_consensus": host_consensus.op7_host_consensus,
    "op8_sampled_splitters": range_shards.op8_sampled_splitters,
    "op9_fuzzy_lines": fuzzy_lines.op9_fuzzy_lines,
    "op10_containment": containment.op10_containment,
    "op11_turn_trie": turn_trie.op11_turn_trie,
    "op12_nra_search": nra_search.op12_nra_search,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

_ORACLE: dict[str, str] = {
    "op10_containment": containment.OP10_SQL,
    "op11_turn_trie": turn_trie.OP11_SQL,
    "op12_nra_search": nra_search.OP12_SQL,
}


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a cluster ships it with --py-files or has it installed)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, paths]))


def _wrapped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_import(spark)
        return fn(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _wrapped(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
