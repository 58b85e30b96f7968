"""The registered queries of these operators, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from emberlake.llm import (
    countjoin,
    decontaminate,
    divergence,
    fingerprint,
    language,
    languagemodel,
    lines,
    maintext,
    merkle,
    mixing,
    neardup,
    quality,
    toxicity,
)
from emberlake.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _shipped(q)
    for q in (
        neardup.op1_superminhash_dedup,
        quality.op2_weak_label_quality,
        lines.op3_site_line_dedup,
        mixing.op4_source_mix,
        maintext.op5_main_text,
        languagemodel.op6_trie_lm,
        fingerprint.op7_cws_fingerprint,
        toxicity.op8_ftrl_toxicity,
        language.op9_ecoc_language,
        decontaminate.op10_spaced_seed_decontaminate,
        countjoin.op11_count_rtree_join,
        merkle.op12_slot_merkle_manifest,
        divergence.op13_quadtree_divergence,
    )
}
SQL: dict[str, str] = {
    "op3_site_line_dedup": lines.SQL,
    "op4_source_mix": mixing.SQL,
    "op11_count_rtree_join": countjoin.SQL,
    "op12_slot_merkle_manifest": merkle.SQL,
    "op13_quadtree_divergence": divergence.SQL,
}
