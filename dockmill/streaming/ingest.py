"""Resumable ingest: a file stream whose checkpoint remembers what was read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dockmill.sources.store import Store


def ingest(spark: SparkSession, folder: str, schema: StructType | str, store: Store, table: str, key: list[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, fmt: str = "json", *, buckets: int = 64, max_files: int = 1000):
    """Upsert new files of ``folder`` into ``table``, once each; call again to go on.

    An upsert by key makes a micro-batch that runs twice harmless.  The table is
    kept in ``buckets``, so a micro-batch of at most ``max_files`` files rewrites
    only those that its keys fall into.
    """

    def write(batch: DataFrame, _: int) -> None:
        store.upsert(table, prepare(batch), key, buckets=buckets)

    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(folder)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
