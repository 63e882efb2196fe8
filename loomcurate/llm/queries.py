"""Queries of the training-data operators over the tables, and their DuckDB SQL."""

from __future__ import annotations

from . import chat_format, jaccard_join, language_id, license_scan, line_dedup, packing, quality_rules, secret_scan, source_mix, vector_search
from .common import table


def op1_best_fit_packing(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"))


def op2_chat_format(spark, sf_dir):
    return chat_format.report(table(spark, sf_dir, "conversations"))


def op3_source_mix(spark, sf_dir):
    return source_mix.report(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_vector_search(spark, sf_dir):
    return vector_search.search(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark, sf_dir):
    return language_id.report(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_chat_format, op3_source_mix, op4_quality_rules, op5_secret_scan, op6_line_dedup, op7_license_scan, op8_vector_search, op9_language_id, op10_jaccard_join)}
ORACLE_SQL = {"op10_jaccard_join": jaccard_join.oracle(), "op3_source_mix": source_mix.oracle(), "op4_quality_rules": quality_rules.oracle(), "op6_line_dedup": line_dedup.oracle()}
