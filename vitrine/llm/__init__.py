"""Operators for large training corpora, and the queries that apply them to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = (
    "arc_warc", "lattice_dedup", "packed_ids", "html_blocks", "curve_packing", "source_mix", "ngram_join", "ppm_language", "suffix_dedup",
    "posting_ann", "importance_resampling", "winnowing", "hard_negatives",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every ``opN_<name>`` query of the subpackage."""
    return {k: f for m in _MODULES for k, f in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for those queries that SQL expresses."""
    return {k: s for m in _MODULES for k, s in getattr(import_module(f"{__name__}.{m}"), "ORACLE_SQL", {}).items()}
