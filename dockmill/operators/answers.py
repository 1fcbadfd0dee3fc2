"""A log of a provider's answers, written while they come.

Asking is slow and costs money, so an answer must not be lost because its task
fails, or another one does.  A data source writer asks: each task appends its
answers to the log every ``SECONDS`` seconds (or ``MOST`` answers), and before it
passes on an error.  A task that starts, also as another attempt or in another
run on the same log, reads what the log has for its prompts and asks for the rest.
What a killed executor can lose is what it got since it last wrote.

The log is a folder of JSON lines, by bucket of the prompt's hash; a prompt that two
attempts asked at the same time is there twice and counts once.  The folder is
any URI that Arrow's file systems know (``s3a://`` is read as ``s3://``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

BUCKETS = 256
SECONDS = 2.0
MOST = 1000
ANSWER = "prompt_hash string, result string"


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@dataclass
class Written(WriterCommitMessage):
    asked: int
    found: int


class _Writer(DataSourceWriter):
    def __init__(self, root: str, call: Callable):
        self.root, self.call = root, call

    def _known(self, bucket: int) -> dict[str, str | None]:
        from pyarrow import fs

        system, path = _system(self.root)
        files = system.get_file_info(fs.FileSelector(f"{path}/{bucket}", allow_not_found=True))
        out: dict[str, str | None] = {}
        for f in files:
            with system.open_input_stream(f.path) as lines:
                for line in lines.read().splitlines():
                    try:
                        row = json.loads(line)
                    except ValueError:  # cut off when its writer was killed
                        continue
                    if row["result"]:  # a blank one is asked for again
                        out[row["prompt_hash"]] = row["result"]
        return out

    def _keep(self, answers: dict[int, list[dict]]) -> None:
        system, path = _system(self.root)
        for bucket, rows in answers.items():
            system.create_dir(f"{path}/{bucket}", recursive=True)
            with system.open_output_stream(f"{path}/{bucket}/{uuid.uuid4().hex}.json") as f:
                f.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        answers.clear()

    def write(self, iterator: Iterator[Row]) -> Written:
        known: dict[int, dict[str, str | None]] = {}
        fresh: dict[int, list[dict]] = {}
        asked, found, since = 0, 0, time.monotonic()
        try:
            for row in iterator:
                bucket = row["bucket"]
                if bucket not in known:
                    known[bucket] = self._known(bucket)
                if row["prompt_hash"] in known[bucket]:
                    found += 1
                    continue
                result = self.call(row["payload"])
                asked += 1
                known[bucket][row["prompt_hash"]] = result
                fresh.setdefault(bucket, []).append({"prompt_hash": row["prompt_hash"], "result": result})
                if asked % MOST == 0 or time.monotonic() - since > SECONDS:
                    self._keep(fresh)
                    since = time.monotonic()
        finally:
            self._keep(fresh)
        return Written(asked, found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        pass  # what was written counts as it is

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        pass  # answers stay for the next run


def _source(call: Callable) -> type[DataSource]:
    class AnswerLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "answer_log"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(self.options["root"], call)

    return AnswerLog


def asked(prompts: DataFrame, call: Callable, root: str, tasks: int | None = None) -> DataFrame:
    """(``prompt_hash``, ``result``) of distinct ``prompts`` (``prompt_hash``, ``payload``), from the log at ``root`` where it has them.

    ``tasks`` ask side by side, by default as many as there are cores; each has
    buckets of its own, and so reads and writes these only.
    """
    spark = prompts.sparkSession
    system, path = _system(root)
    system.create_dir(path, recursive=True)
    spark.dataSource.register(_source(call))
    bucket = F.pmod(F.xxhash64("prompt_hash"), F.lit(BUCKETS)).cast("int")
    dealt = prompts.select("prompt_hash", "payload", bucket.alias("bucket")).repartition(tasks or spark.sparkContext.defaultParallelism, "bucket")
    dealt.write.format("answer_log").mode("append").option("root", root).save()
    log = spark.read.schema(ANSWER).option("recursiveFileLookup", "true").json(root).where(F.col("prompt_hash").isNotNull())
    return log.join(prompts.select("prompt_hash"), "prompt_hash", "left_semi").groupBy("prompt_hash").agg(F.max("result").alias("result"))
