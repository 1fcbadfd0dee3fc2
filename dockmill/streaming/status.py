"""Status counters as keyed state of a stream.

:func:`dockmill.operators.collection.fold_status` reads the whole log each time.
Here each item's last status, its version and its failures are state, so a
micro-batch costs what is new in it.  What changed is upserted into a table;
state and offsets live in the checkpoint, and a batch that runs twice upserts the
same rows, so a restart in mid-stream changes nothing.

Events may come in any order: the greatest version wins, and of equal versions
the first to come.  A null version is less than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from dockmill.sources.store import Store

STATE = "major long, minor long, status string, error_message string, attempt_count long"
LEAST = -(2**63)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Counter(StatefulProcessor):
    """Folds an item's events into its state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.item = handle.getValueState("item", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        major, minor, status, error, attempts = self.item.get() if self.item.exists() else (LEAST, LEAST, None, None, 0)
        fresh = not self.item.exists()
        for batch in rows:
            attempts += int((batch["status"] == "failed").sum())
            for a, b, s, e in zip(batch["major"], batch["minor"], batch["status"], batch["error_message"], strict=True):
                if fresh or (a, b) > (major, minor):
                    major, minor, status, error, fresh = int(a), int(b), s, e, False
        self.item.update((major, minor, status, error, attempts))
        shown = None if status == "completed" else error
        yield pd.DataFrame({"comment_id": [key[0]], "status": [status], "attempt_count": [attempts], "error_message": [shown]})

    def close(self) -> None:
        pass


def counted(events: DataFrame, major: str = "major", minor: str = "minor") -> DataFrame:
    """The stream of changed items (``comment_id``, ``status``, ``attempt_count``, ``error_message``) of a stream of events.

    ``events``: ``comment_id``, ``status``, ``error_message`` and the version in two longs.
    """
    typed = events.select("comment_id", "status", F.col("error_message").cast("string").alias("error_message"), *(F.coalesce(F.col(c).cast("long"), F.lit(LEAST)).alias(n) for c, n in ((major, "major"), (minor, "minor"))))
    kind = dict(typed.dtypes)["comment_id"]
    out = f"comment_id {kind}, status string, attempt_count long, error_message string"
    return typed.groupBy("comment_id").transformWithStateInPandas(Counter(), outputStructType=out, outputMode="Update", timeMode="None")


def keep_status(events: DataFrame, store: Store, table: str, checkpoint: str, *, buckets: int = 64, major: str = "major", minor: str = "minor"):
    """Upsert the changed items of all events that are there into ``table``; call again to go on."""
    spark = events.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)  # the query keeps it with its checkpoint
    try:
        query = (
            counted(events, major, minor)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, _: store.upsert(table, batch, ["comment_id"], buckets=buckets))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return query
