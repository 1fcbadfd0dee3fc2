"""Cached text generation with a pluggable provider, and repairs of its output.

The cache is content-addressed by prompt and model.  Each distinct prompt that
misses is generated once, whatever number of rows asks for it.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from dockmill.operators.answers import asked
from dockmill.plans.shared import materialize, new_path

Provider = Callable[[str], str]


def stub(prompt: str) -> str:
    """Offline provider: a short answer that depends on the prompt alone."""
    return json.dumps({"relevance": 1, "digest": hashlib.sha256(prompt.encode()).hexdigest()[:12]})


PROVIDERS: dict[str, Provider] = {"stub": stub}


def provider(name: str) -> Provider:
    if name not in PROVIDERS:
        raise KeyError(f"unknown model {name!r}; known: {sorted(PROVIDERS)}")
    return PROVIDERS[name]


class Busy(Exception):
    """The provider asks to try again later."""


def with_retry(call: Provider, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> Provider:
    def run(prompt: str) -> str:
        for attempt in range(tries):
            try:
                return call(prompt)
            except Busy:
                if attempt == tries - 1:
                    raise
                sleep(min(5.0 * 2**attempt, 60.0))
        raise RuntimeError("no tries")

    return run


def with_timeout(call: Provider, seconds: float) -> Provider:
    def run(prompt: str) -> str:
        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(call, prompt).result(seconds)
        finally:
            pool.shutdown(wait=False)

    return run


def generate(prompts: DataFrame, prompt: str, model: str, cache: DataFrame | None = None, *, task_type: str = "generate", concurrency: int | None = None, post: Callable[[Column], Column] | None = None, log: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(``prompts`` with ``prompt_hash``, ``result`` and, with ``post``, ``parsed``; new cache rows).

    ``post`` turns a result into what the caller wants, NULL if it can't.  A
    cached result that is blank or that ``post`` can't use is asked for again,
    and the fresh one counts.  A prompt has one result however many rows the
    cache has for it: the latest usable one.  ``log``: a folder that keeps answers as
    they come (:mod:`dockmill.operators.answers`), for another run to go on from; by
    default a new one, which saves them from tasks that fail.
    """
    keyed = prompts.withColumn("prompt_hash", F.sha2(F.concat_ws("\n", F.lit(model), F.col(prompt)), 256))
    return _answered(keyed, F.col(prompt), "string", with_retry(provider(model)), model, cache, task_type, concurrency, post, log)


PARTS = "array<struct<mime:string,text:string,data:binary>>"
MultimodalProvider = Callable[[list[dict]], str]


def stub_multimodal(parts: list[dict]) -> str:
    """Offline provider for parts: an answer that depends on their types, texts and bytes alone."""
    return stub("\n".join(f"{p['mime']} {p['text'] or ''} {hashlib.sha256(bytes(p['data'] or b'')).hexdigest()}" for p in parts))


MULTIMODAL: dict[str, MultimodalProvider] = {"stub": stub_multimodal}


def parts_key(model: str, parts: Column) -> Column:
    """Hash of typed parts: of each its type, text and the hash of its bytes, so blobs of equal length differ."""
    of = F.transform(parts, lambda p: F.concat_ws("\u0001", F.coalesce(p.mime, F.lit("")), F.sha2(F.coalesce(p.text, F.lit("")), 256), F.sha2(F.coalesce(p.data, F.lit(b"")), 256)))
    return F.sha2(F.concat_ws("\n", F.lit(model), F.array_join(of, "\n")), 256)


def generate_multimodal(rows: DataFrame, parts: str, model: str, cache: DataFrame | None = None, *, task_type: str = "multimodal", concurrency: int | None = None, post: Callable[[Column], Column] | None = None, log: str | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`generate` for a column of typed parts (``PARTS``) in place of a prompt."""
    if model not in MULTIMODAL:
        raise KeyError(f"unknown model {model!r}; known: {sorted(MULTIMODAL)}")
    keyed = rows.withColumn("prompt_hash", parts_key(model, F.col(parts)))
    call = with_retry(MULTIMODAL[model])
    return _answered(keyed, F.col(parts), PARTS, lambda p: call([x.asDict() if isinstance(x, Row) else dict(x) for x in p]), model, cache, task_type, concurrency, post, log)


def _answered(keyed: DataFrame, payload: Column, kind: str, call: Callable, model: str, cache: DataFrame | None, task_type: str, concurrency: int | None, post, log: str | None) -> tuple[DataFrame, DataFrame]:
    wanted = keyed.select("prompt_hash", payload.cast(kind).alias("payload")).dropDuplicates(["prompt_hash"])
    usable = None
    if cache is not None:
        good = F.coalesce(F.col("result") != "", F.lit(False))
        if post is not None:
            good = good & post(F.col("result")).isNotNull()
        last = F.max_by("result", "created_at") if "created_at" in cache.columns else F.max("result")
        usable = cache.where(good).groupBy("prompt_hash").agg(last.alias("result"))
        wanted = wanted.join(usable.select("prompt_hash"), "prompt_hash", "left_anti")
    fresh = asked(wanted, call, new_path(wanted.sparkSession, "answers") if log is None else log, concurrency)
    fresh = fresh.select("prompt_hash", F.lit(task_type).alias("task_type"), "result", F.lit(model).alias("model"), F.current_timestamp().alias("created_at"))
    fresh = materialize(fresh, "generated")  # a provider is asked once
    known = fresh.select("prompt_hash", "result")
    if usable is not None:
        known = known.unionByName(usable)
    out = keyed.join(known, "prompt_hash", "left")
    return out if post is None else out.withColumn("parsed", post(F.col("result"))), fresh


def verify_cache(cache: DataFrame) -> DataFrame:
    """Entries without a result."""
    return cache.where("result is null or result = ''")


def suffix_ids(known: DataFrame) -> DataFrame:
    """(``suffix``, ``id``): suffixes after a hyphen that only one known id has."""
    parts = F.split("id", "-")
    at = F.when(F.size(parts) > 1, F.sequence(F.lit(2), F.size(parts))).otherwise(F.array().cast("array<int>"))
    exploded = known.select("id").distinct().select("id", F.explode(F.transform(at, lambda i: F.array_join(F.slice(F.split("id", "-"), i, 1000), "-"))).alias("suffix"))
    return exploded.groupBy("suffix").agg(F.count("*").alias("n"), F.max("id").alias("id")).where("n = 1").select("suffix", "id")


def repair_ids(value, known: set[str], unique: dict[str, str]):
    """Partial ids under ``commentId`` and ``commentIds`` anywhere in a JSON value, completed where that is unambiguous."""

    def one(x):
        return x if not isinstance(x, str) or x in known else unique.get(x.lstrip("-"), x)

    if isinstance(value, list):
        return [repair_ids(v, known, unique) for v in value]
    if isinstance(value, dict):
        return {k: one(v) if k == "commentId" else [one(x) for x in v] if k == "commentIds" and isinstance(v, list) else repair_ids(v, known, unique) for k, v in value.items()}
    return value
