"""JSON documents and reports for a browser: small results, written by the driver.

Large tables are written by executors as JSON lines; the driver only collects
what a page shows.
"""

from __future__ import annotations

import html
import json
import os
import zipfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object a row; NULL fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_document(df: DataFrame, path: str, shape: str = "array", key: str | None = None, most: int = 1_000_000) -> None:
    """One pretty-printed JSON file: an array, or a map by ``key``.  Raises beyond ``most`` rows: those belong into lines."""
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct("*"))).limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for one document; use write_lines")
    value = rows if shape == "array" else {r.pop(key): r for r in rows}
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as f:
        json.dump(value, f, indent=2, ensure_ascii=False)


def meta(document: DataFrame, stats: DataFrame, now: Column) -> DataFrame:
    """The description of a collection with its counters."""
    return document.crossJoin(stats).select(F.col("docket_id").alias("documentId"), F.col("document_id").alias("sourceDocumentId"), "title", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generatedAt"), F.struct(*stats.columns).alias("stats"))  # one row each


def _shown(df: DataFrame, most: int) -> tuple[list, int]:
    """(the first ``most`` rows, how many more there are)."""
    rows = df.limit(most + 1).collect()
    return rows[:most], df.count() - most if len(rows) > most else 0


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """The first rows as a Markdown table; a last line says how many are left out."""
    rows, more = _shown(df, most)
    out = ["| " + " | ".join(df.columns) + " |", "|" + " - |" * len(df.columns)]
    out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
    return "\n".join(out + [f"\n{more} more rows are not shown."] * (more > 0))


def html_page(title: str, df: DataFrame, most: int = 1000) -> str:
    """A plain page with a table of the first rows; a last line says how many are left out."""
    cells = lambda tag, xs: "".join(f"<{tag}>{html.escape('' if x is None else str(x))}</{tag}>" for x in xs)
    rows, more = _shown(df, most)
    body = "".join(f"<tr>{cells('td', r)}</tr>" for r in rows)
    rest = f"<p>{more} more rows are not shown.</p>" if more else ""
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{cells('th', df.columns)}</tr>{body}</table>{rest}"


def zip_texts(path: str, folder: str, texts: dict[str, str]) -> None:
    """A zip with the texts as files of one folder; the same texts give the same bytes."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in sorted(texts.items()):
            z.writestr(zipfile.ZipInfo(f"{folder}/{name}"), text, zipfile.ZIP_DEFLATED)


# The documents of an export.
DOCUMENTS = {
    "meta": "meta.json",
    "themes": "themes.json",
    "theme_summaries": "theme-summaries.json",
    "entities": "entities.json",
    "comments": "comments.json",
    "theme_index": "indexes/theme-comments.json",
    "entity_index": "indexes/entity-comments.json",
    "theme_extracts": "theme-extracts.json",
}
OPTIONAL = {"theme_extracts"}


def load_documents(folder: str) -> dict[str, object]:
    """The documents of an export by name, read side by side; one that may be missing is then empty."""

    def load(name: str) -> object:
        try:
            with open(os.path.join(folder, DOCUMENTS[name])) as f:
                return json.load(f)
        except (OSError, ValueError):
            if name in OPTIONAL:
                return {}
            raise

    with ThreadPoolExecutor(len(DOCUMENTS)) as pool:
        return dict(zip(DOCUMENTS, pool.map(load, DOCUMENTS), strict=True))


def scan_document(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One document of an export as a table: a row an element of an array, or one row of a map."""
    return spark.read.option("multiLine", True).json(f"{folder}/{DOCUMENTS[name]}")
