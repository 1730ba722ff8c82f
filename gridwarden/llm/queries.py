"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridwarden.llm import bpe, chat, circulant, decontaminate, html_main, language, line_dedup, merkle, ngram_join, periodic, topk, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.toxicity_query,
        "op2_language_id": language.language_query,
        "op3_bpe": bpe.bpe_query,
        "op4_benchmark_decontamination": decontaminate.decontamination_query,
        "op5_html_extraction": html_main.html_query,
        "op6_line_dedup": line_dedup.line_query,
        "op7_ngram_jaccard_join": ngram_join.join_query,
        "op8_exact_top_k": topk.top_k_query,
        "op9_chat_formatting": chat.chat_query,
        "op10_warc": warc.warc_query,
        "op11_merkle_manifest": merkle.manifest_query,
        "op12_periodic_runs": periodic.runs_query,
        "op13_circulant_near_dedup": circulant.near_dedup_query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_benchmark_decontamination": decontaminate.ORACLE,
        "op6_line_dedup": line_dedup.ORACLE,
        "op8_exact_top_k": topk.ORACLE,
        "op9_chat_formatting": chat.ORACLE,
        "op11_merkle_manifest": merkle.ORACLE,
    }
