"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of their docs, whatever further columns these have and however they are named; the
columns doc_id, text, lang, source and n_chars are read. An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcurate.llm import jaccard_join, line_dedup, packing, quality_rules, source_mix
from loomcurate.llm.common import BLANKS, gathering, release, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified thresholds reject go.

    Null and empty texts have no words, so they go; a null lang is a stratum of its own; a null id is judged like any other;
    repeated rows are judged alike, so both stay or go; texts of any length are counted whole. Without labels no cutoff is
    certified and only the base rules decide.
    """
    return quality_rules.apply(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, but for their first place; so do documents of which nothing is left. n_chars follows the text.

    Null texts and texts of white space go; a null source is a site of its own; of equal places the one with the least id
    (null first) keeps the line; repeated rows are one document and keep the same lines, both; long texts are rewritten whole.
    """
    cleaned = line_dedup.clean(docs).where(F.btrim("text", F.lit(BLANKS)) != "")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id.

    Documents without words are linked with nothing and all stay; of repeated rows one stays; a null id stays only where all
    ids of its group are null; of equal ids the text with the least hash stays; sets of long texts are compared whole.
    """
    return jaccard_join.apply(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, kept or repeated (round(taken / size) whole copies) as their source's target asks.

    Texts without words have no size and go; a null source comes last in the order of sources; repeated rows and null ids are
    rows like any other; ties are broken by seeded hashes of id and text, so reruns agree.
    """
    return source_mix.apply(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences.

    Null and empty texts are a piece of one id, the end; texts over the capacity are cut; repeated rows and null ids are packed
    like any other; pieces of equal length go by id, piece and checksum.
    """
    return packing.report(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("source mix", mix), ("packing", pack)]

#: Tokenising and packing are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces and sequences that all stages make of ``documents``.

    Each stage's result is a table; what the stage stored on the way, and the result before it, go once it is written.
    The returned frame reads only tables of its own call, which stay as long as any plan reads them.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for _, apply in STAGES[:-1]:
        with gathering() as made:
            result = stored(apply(spark, docs, sf_dir))
        latest = made.pop()
        release(made + before)
        docs, before = result, [latest]
    return STAGES[-1][1](spark, docs, sf_dir)
