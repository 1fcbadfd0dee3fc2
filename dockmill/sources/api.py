"""A paged REST source of comments, read by executors; pages may be replayed from files.

Requests go through a :class:`Fetch`, so tests and offline runs pass a
:class:`Replay`.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 250


def backoff(attempt: int, first: float = 5.0, most: float = 120.0) -> float:
    """Seconds before try ``attempt`` + 1: doubling up to a bound."""
    return min(first * 2**attempt, most)


class Fetch(Protocol):
    """Answers URLs: a call gives parsed JSON, :meth:`download` a file's bytes."""

    def __call__(self, url: str) -> dict: ...

    def download(self, url: str) -> bytes: ...


class Http:
    """Fetch over HTTP; a 429 waits and tries again."""

    def __init__(self, key: str = "", tries: int = 10, sleep: Callable[[float], None] = time.sleep, open_: Callable = urllib.request.urlopen):
        self.key, self.tries, self.sleep, self.open = key, tries, sleep, open_

    def __call__(self, url: str) -> dict:
        return json.loads(self._read(url, {"X-Api-Key": self.key}))

    def download(self, url: str) -> bytes:
        return self._read(url, {"Accept": "application/pdf,*/*"})

    def _read(self, url: str, headers: dict[str, str]) -> bytes:
        for attempt in range(self.tries):
            try:
                with self.open(urllib.request.Request(url, headers=headers)) as r:
                    return r.read()
            except urllib.error.HTTPError as e:
                if e.code != 429 or attempt == self.tries - 1:
                    raise
                self.sleep(backoff(attempt))
        raise RuntimeError("no tries")


class Replay:
    """Answers from a dictionary of URLs: JSON values, and bytes for files."""

    def __init__(self, pages: dict[str, dict | bytes]):
        self.pages = pages

    def __call__(self, url: str) -> dict:
        return self.pages[url]

    def download(self, url: str) -> bytes:
        return self.pages[url]


def list_comments(base: str, object_id: str, fetch: Fetch) -> Iterator[dict]:
    """All listed comments of a document; a page that is not full is the last."""
    page = 1
    while True:
        rows = fetch(f"{base}/comments?filter[commentOnId]={object_id}&page[size]={PAGE}&page[number]={page}")["data"]
        yield from rows
        if len(rows) < PAGE:
            return
        page += 1


_DETAILS = "id string, attributes_json string, attachments array<struct<id:string,format:string,file_name:string,url:string,size:bigint,blob_data:binary>>"


def _files(base: str, attachment: str, fetch: Fetch, download: bool) -> Iterator[dict]:
    """The formats of one attachment, with their bytes if asked for."""
    found = fetch(f"{base}/attachments/{attachment}?include=fileFormats")["data"]["attributes"].get("fileFormats") or []
    for f in found:
        if url := f.get("downloadUrl") or f.get("fileUrl"):
            kind = (f.get("fileFormat") or f.get("format") or "bin").lower()
            blob = fetch.download(url) if download else None
            size = f.get("size") if blob is None else len(blob)
            yield {"id": f.get("formatId") or attachment, "format": kind, "file_name": f"{attachment}.{kind}", "url": url, "size": size or None, "blob_data": blob}


def fetch_details(ids: DataFrame, base: str, fetch: Fetch, *, download: bool = True, report: bool = False) -> DataFrame:
    """(``id``, ``attributes_json``, ``attachments`` with their bytes); a comment with an attachment that fails is left out whole.

    ``download=False`` keeps the list of files and leaves their bytes out.
    ``report=True`` gives those that failed too, with nulls and the reason in ``error``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                try:
                    got = fetch(f"{base}/comments/{i}?include=attachments")["data"]
                    listed = ((got.get("relationships") or {}).get("attachments") or {}).get("data") or []
                    files = [f for a in listed for f in _files(base, a["id"], fetch, download)]
                    row = (i, json.dumps(got["attributes"]), files, None)
                except (KeyError, OSError, ValueError) as e:
                    row = (i, None, None, f"{type(e).__name__}: {e}")
                if report or row[3] is None:
                    yield pd.DataFrame([row], columns=["id", "attributes_json", "attachments", "error"])

    found = ids.select("id").mapInPandas(run, f"{_DETAILS}, error string")
    return found if report else found.drop("error")


METADATA = ["docketId", "agencyId", "agencyName", "documentType", "title", "postedDate", "commentStartDate", "commentEndDate"]


def fetch_metadata(ids: DataFrame, base: str, fetch: Fetch, stored: DataFrame | None = None) -> DataFrame:
    """Rows of ``document_metadata`` for the document ids that have none yet; ids that can't be fetched are left out."""
    wanted = ids.select("document_id").distinct()
    if stored is not None:
        wanted = wanted.join(stored.select("document_id").distinct(), "document_id", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["document_id"]:
                try:
                    found = fetch(f"{base}/documents/{i}")["data"]["attributes"]
                except (KeyError, OSError, ValueError):
                    continue
                yield pd.DataFrame([(i, *(found.get(k) for k in METADATA), json.dumps(found))])

    names = [re.sub("([A-Z])", r"_\1", k).lower() for k in METADATA]
    return wanted.mapInPandas(run, ", ".join(f"{c} string" for c in ["document_id", *names, "metadata_json"]))


def load_document(spark: SparkSession, base: str, document_id: str, fetch: Fetch, stored: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Details of a document's comments that are not stored yet; executors read the list's pages and the details."""
    from dockmill.operators.collection import only_new
    from dockmill.sources.paged import listed

    object_id = fetch(f"{base}/documents/{document_id}")["data"]["attributes"]["objectId"]
    rows = listed(spark, base, object_id, fetch).select("id", "ord")
    if stored is not None:
        rows = only_new(rows, stored, "id", limit)
    elif limit is not None:
        rows = rows.orderBy("ord").limit(limit)
    return fetch_details(rows.where(F.col("id").isNotNull()), base, fetch)
