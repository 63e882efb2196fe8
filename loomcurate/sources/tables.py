"""Stage tables as JSON lines, documents as JSON, and the cache of embeddings."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that Spark uses for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read(spark: SparkSession, path: str, table: schemas.Table, ordered: bool = False) -> DataFrame:
    """A validated scan: empty where the path is missing, blank lines skipped, a bad line or missing field fails.

    ``ordered`` adds ``batch`` and ``position``, the order in which ``append`` wrote the rows; rows that other tools wrote
    come first, in file order.
    """
    schema = T.StructType([*table.schema.fields, *schemas.ORDER.schema.fields]) if ordered else table.schema
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = table.checked(spark.read.schema(schema).option("mode", "FAILFAST").json(path))
    if ordered:
        rows = rows.withColumns({"batch": F.coalesce("batch", F.lit(0).cast("long")), "position": F.coalesce("position", F.monotonically_increasing_id())})
    return rows


def write(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def append(rows: DataFrame, path: str) -> None:
    """Rows added to a table, with the time of the append and their place in it, so the last of a key can be told."""
    write(rows.withColumns({"batch": F.lit(time.time_ns() // 1000).cast("long"), "position": F.monotonically_increasing_id()}), path, append=True)


def kept(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` computed once: written and read again."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank; 0 where the path is missing."""
    if not exists(spark, path):
        return 0
    return spark.read.text(path).where(F.trim("value") != "").count()


def load_processed_ids(spark: SparkSession, path: str, field: str = "id") -> DataFrame:
    """Distinct ids in an output, as (field); lines without the field are ignored."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"`{field}` string")
    rows = spark.read.schema(f"`{field}` string").json(path)
    return rows.where(F.col(field).isNotNull()).distinct()


def write_training(examples: DataFrame, path: str) -> None:
    """Only the messages, without null keys."""
    examples.select("messages").write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"messages {schemas.MESSAGES}").json(path)


def write_document(row: DataFrame, path: str) -> None:
    """A one-row document (column ``value``) as text."""
    row.select("value").coalesce(1).write.mode("overwrite").text(path)


def read_sidecar(spark: SparkSession, path: str) -> DataFrame | None:
    """The sidecar document; None where it is missing."""
    if not exists(spark, path):
        return None
    kind = "map<string,long>"
    return spark.read.schema(
        f"total_examples long, complexity_distribution {kind}, primitive_distribution {kind}, domain_distribution {kind}, avg_quality_score double"
    ).option("multiLine", "true").json(path)


def publish(examples: DataFrame, publisher=None, repository: str | None = None) -> bool:
    """Hand the set to ``publisher(examples, repository)`` if both are given; nothing is sent otherwise."""
    if publisher is None or not repository:
        return False
    publisher(examples, repository)
    return True


def embeddings(spark: SparkSession, rows: DataFrame, key: str, text: str, encode, path: str) -> DataFrame:
    """(key, digest, embedding) of all rows: what the cache has for the id and text, and the rest encoded and added.

    ``encode``: a column function text -> array<float>.
    """
    wanted = rows.select(F.col(key), F.sha2(F.col(text), 256).alias("digest"), F.col(text).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, digest string, embedding array<float>"
    if exists(spark, path):
        cached = spark.read.schema(schema).parquet(path)
        fresh = wanted.join(cached, [key, "digest"], "left_anti")
    else:
        fresh = wanted
    fresh.select(key, "digest", encode(F.col("_text")).alias("embedding")).write.mode("append").parquet(path)
    return wanted.drop("_text").join(spark.read.schema(schema).parquet(path).dropDuplicates([key, "digest"]), [key, "digest"])
