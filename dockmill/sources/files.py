"""Attachment files and stored collections."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOOLS = {"pdf": ["pdftotext", "-", "-"], "docx": ["pandoc", "-f", "docx", "-t", "plain"]}


def scan_attachments(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` as (``path``, ``format``, ``size``, ``blob_data``)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("format"), F.col("length").alias("size"), F.col("content").alias("blob_data"))


def extract_text(attachments: DataFrame) -> DataFrame:
    """``text`` of each attachment: txt in the JVM, pdf and docx by tools where an executor has them, else empty."""
    plain = attachments.where("format = 'txt'").withColumn("text", F.make_valid_utf8(F.col("blob_data").cast("string")))
    other = attachments.where("format is null or format <> 'txt'")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df["text"] = [_convert(f, b) for f, b in zip(df["format"], df["blob_data"], strict=True)]
            yield df

    schema = other.withColumn("text", F.lit("")).schema
    return plain.unionByName(other.mapInPandas(run, schema))


def _convert(kind: str | None, blob: bytes | None) -> str:
    tool = _TOOLS.get(kind or "")
    if not blob or tool is None or shutil.which(tool[0]) is None:
        return ""
    return subprocess.run(tool, input=bytes(blob), capture_output=True, check=False).stdout.decode("utf-8", "replace")


def list_collections(names: list[str], suffix: str = ".sqlite") -> list[str]:
    """Names of stores among file names, without journals and backups."""
    return sorted(n.removesuffix(suffix) for n in names if n.endswith(suffix) and f"{suffix}-" not in n and f"{suffix}." not in n)
