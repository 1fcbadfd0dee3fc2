"""Status counters kept by a stream equal the fold of the whole log, across restarts."""

import random

import pytest
from pyspark.sql import functions as F

from dockmill.operators.collection import fold_status
from dockmill.sources.store import Store
from dockmill.streaming.status import keep_status

EVENT = "comment_id long, status string, error_message string, major long, minor long"


def test_equal_to_the_fold_after_restarts(spark, tmp_path):
    rng = random.Random(6)
    log = [(rng.randrange(12), rng.choice(["pending", "failed", "completed"]), f"e{i}", i // 3, i) for i in range(90)]
    rng.shuffle(log)
    folder, store = tmp_path / "events", Store(spark, f"file://{tmp_path}/store")

    def add(at, rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").json(f"{folder}/{at}")

    def events():
        return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{folder}/*")

    def same(rows):
        frame = spark.createDataFrame(rows, EVENT).withColumn("version", F.struct("major", "minor"))
        assert sorted(map(tuple, store.read("status").select("comment_id", "status", "attempt_count", "error_message").collect())) == sorted(map(tuple, fold_status(frame).collect()))

    for i in range(3):
        add(i, log[i * 15 : i * 15 + 15])
    whole, failing = store.upsert, {"n": 0}

    def upsert(*args, **how):
        failing["n"] += 1
        whole(*args, **how)
        if failing["n"] == 2:  # the second batch is written and not committed
            raise RuntimeError("lost driver")

    store.upsert = upsert
    with pytest.raises(Exception, match="lost driver"):
        keep_status(events(), store, "status", f"{tmp_path}/at", buckets=4)
    keep_status(events(), store, "status", f"{tmp_path}/at", buckets=4)
    same(log[:45])
    for i in range(3, 6):
        add(i, log[i * 15 : i * 15 + 15])
    keep_status(events(), store, "status", f"{tmp_path}/at", buckets=4)
    same(log)
    keep_status(events(), store, "status", f"{tmp_path}/at", buckets=4)
    same(log)
