"""The operators' queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, clusters, divergence, langid, licenses, lines, packing, pieces, quality, simhash, substring, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.query,
    "op2_language_id": langid.query,
    "op3_sentencepiece": pieces.query,
    "op4_line_dedup": lines.query,
    "op5_simhash": simhash.query,
    "op6_nearest_neighbours": ann.query,
    "op7_warc_derivatives": warc.query,
    "op8_substring_dedup": substring.query,
    "op9_license_scan": licenses.query,
    "op10_quality_rules": quality.query,
    "op11_token_counts": tokens.query,
    "op12_source_divergence": divergence.query,
    "op13_centroid_clusters": clusters.query,
}

ORACLE_SQL: dict[str, str] = {"op4_line_dedup": lines.SQL, "op12_source_divergence": divergence.SQL, "op13_centroid_clusters": clusters.SQL}
