"""The operators as queries over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import collocations, decontamination, html_extraction, language_id, merkle, mixing, quality, sharding, simhash, substring_dedup, suffix_dedup, token_counts, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.op1_simhash,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_sharding": sharding.op5_sharding,
    "op6_language_id": language_id.op6_language_id,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality": quality.op8_quality,
    "op9_html_extraction": html_extraction.op9_html_extraction,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_merkle": merkle.op11_merkle,
    "op12_collocations": collocations.op12_collocations,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

ORACLES: dict[str, str] = {
    "op2_url_filter": url_filter.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_substring_dedup": substring_dedup.ORACLE,
}
