"""Per-row phases over a growing folder: each micro-batch leaves out what is stored, and appends the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import keyed
from ..schemas import Table
from ..sources import tables


def run(spark: SparkSession, source: str, table: Table, key: str, phase: Callable[[DataFrame], DataFrame], target: str, target_key: str, checkpoint: str) -> StreamingQuery:
    """Start a query that reads new JSON files of ``source`` and appends ``phase`` of unseen rows to ``target``.

    A batch that is run again finds its rows stored and appends nothing twice.
    """

    def append(batch: DataFrame, _: int) -> None:
        done = tables.load_processed_ids(spark, target, target_key)
        fresh = keyed.remaining(table.checked(batch).dropDuplicates([key]), key, done, target_key)
        tables.append(phase(fresh), target)

    stream = spark.readStream.schema(table.schema).option("mode", "FAILFAST").json(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
