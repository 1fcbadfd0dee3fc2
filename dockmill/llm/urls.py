"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

A rule ``host/path`` fits a URL on that host or a subdomain whose path starts
with the rule's; the longest fitting rule decides.  Where none fits, boosted
trees judge the URL by its letters alone: lengths, depth, digits, entropy,
parameters, and how often URLs under the same host suffixes were blocked among
the labelled ones.  Trees are grown on the driver from a bounded sample,
``max_rows`` labelled URLs with the smallest hashes; every URL is judged.  The
suffix statistics that a URL is trained with come from the other folds, so a
tree doesn't learn from a share that holds the URL's own verdict.

Up to ``MAX_RULES`` rules go to every task; a larger set, or one given as a
table, is joined by host suffix.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule, and is judged by the trees like any other; without labelled
URLs of both verdicts the trees answer with the one verdict there is, or allow;
every row gives one row; columns named like an output are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.llm.sampling import smallest
from dockmill.plans.shared import spread

MAX_ROWS = 20_000
MAX_RULES = 100_000
FOLDS = 5
_LOWER = {c: c + 32 for c in range(65, 91)}


def parse(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_LOWER), path[:stop]


class Rules:
    """Rules by host, looked up by the suffixes of a URL's host."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((rule, "/" + path, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest fitting rule and its verdict; of equally long ones the first by name, of equal ones the first verdict by name."""
        best, labels = None, host.split(".")
        for i in range(len(labels)):
            for rule, start, verdict in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(start) and (best is None or (-len(rule), rule, verdict) < (-len(best[0]), *best)):
                    best = rule, verdict
        return best or (None, None)


@dataclass
class Lexical:
    """Lexical features; the suffix statistics are fitted."""

    rates: dict[str, float] = field(default_factory=dict)
    base: float = 0.0

    NAMES = ("length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "entropy", "parameters", "query_length", "hyphens", "longest_label", "upper", "suffix1", "suffix2", "suffix3")

    def fit(self, urls: list[str | None], blocked: np.ndarray) -> None:
        """Smoothed shares of blocked URLs by host suffix of one to three labels."""
        self.base = float(blocked.mean()) if len(blocked) else 0.0
        seen, bad = Counter(), Counter()
        for u, y in zip(urls, blocked, strict=True):
            for s in self.suffixes(parse(u)[0]):
                seen[s] += 1
                bad[s] += int(y)
        self.rates = {s: (bad[s] + 5 * self.base) / (n + 5) for s, n in seen.items() if n >= 5}

    @staticmethod
    def suffixes(host: str) -> list[str]:
        labels = host.split(".")
        return [".".join(labels[-n:]) for n in (1, 2, 3)]

    def matrix(self, urls: list[str | None]) -> np.ndarray:
        return np.array([self.row(u or "") for u in urls], np.float32).reshape(len(urls), len(self.NAMES))

    def row(self, url: str) -> list[float]:
        host, path = parse(url)
        query = url.partition("?")[2].partition("#")[0]
        n = max(1, len(url))
        counts = np.array(list(Counter(url).values()) or [1.0])
        digits = sum(c.isdigit() for c in url)
        share = counts / counts.sum()
        return [
            len(url), len(host), len(path), path.count("/"), host.count(".") + 1, digits, digits / n, float(-(share * np.log2(share)).sum()),
            query.count("=") or query.count("&"), len(query), url.count("-"), max(map(len, host.split("."))), sum(c.isupper() for c in url),
            *(self.rates.get(s, self.base) for s in self.suffixes(host)),
        ]


@dataclass
class Boosted:
    """Gradient-boosted trees for the log loss, grown on quantile bins."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.15
    n_bins: int = 32
    least: float = 5.0
    start: float = 0.0
    trees: list[list[tuple[int, float, float]]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        self.start, self.trees = float(np.log(mean / (1 - mean))), []
        if y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.n_bins + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(bins, cuts, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, x)
        return self

    def _grow(self, bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> list[tuple[int, float, float]]:
        """A full binary tree in an array: (feature or -1, cut, value)."""
        tree = [(-1, 0.0, 0.0)] * (2 ** (self.depth + 1) - 1)
        members = {0: np.arange(len(g))}
        for node in range(len(tree)):
            rows = members.pop(node, None)
            if rows is None:
                continue
            tree[node] = (-1, 0.0, self.rate * g[rows].sum() / (h[rows].sum() + 1.0))
            if node < 2**self.depth - 1 and (split := self._split(bins[rows], g[rows], h[rows])):
                f, b = split
                tree[node] = (f, float(cuts[f][b]), tree[node][2])
                left = bins[rows, f] <= b
                members[2 * node + 1], members[2 * node + 2] = rows[left], rows[~left]
        return tree

    def _split(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
        best, found = 1e-6, None
        whole_g, whole_h = g.sum(), h.sum()
        for f in range(bins.shape[1]):
            gs = np.cumsum(np.bincount(bins[:, f], g, self.n_bins))[:-1]
            hs = np.cumsum(np.bincount(bins[:, f], h, self.n_bins))[:-1]
            gain = gs**2 / (hs + 1) + (whole_g - gs) ** 2 / (whole_h - hs + 1) - whole_g**2 / (whole_h + 1)
            gain[(hs < self.least) | (whole_h - hs < self.least)] = 0
            b = int(gain.argmax())
            if gain[b] > best:
                best, found = gain[b], (f, b)
        return found

    @staticmethod
    def _walk(tree: list[tuple[int, float, float]], x: np.ndarray) -> np.ndarray:
        feature, cut, value = (np.array(c) for c in zip(*tree, strict=True))
        at = np.zeros(len(x), np.int64)
        while (inner := feature[at] >= 0).any():
            right = x[np.arange(len(x)), np.maximum(feature[at], 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of being blocked."""
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self._walk(tree, x)
        return 1 / (1 + np.exp(-score))


def _judged(df: DataFrame, url: str, carry: list[str], made: dict[str, T.DataType], judge) -> DataFrame:
    rest = [f for f in df.schema.fields if f.name in carry and f.name not in made]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = judge(batch.column("__url").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, names=[*names, *made])

    return df.select(*names, F.col(url).alias("__url")).mapInArrow(run, T.StructType([*rest, *(T.StructField(k, v) for k, v in made.items())]))


_RULED = ("host", "path", "rule", "verdict")


def apply_rules(df: DataFrame, url: str, carry: list[str], rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """Columns ``carry`` with ``host``, ``path``, ``rule`` and the rule's ``verdict``.

    ``rules``: (rule, verdict) pairs, or a table of such columns.
    """
    if isinstance(rules, DataFrame):
        return _joined_rules(df, url, carry, rules)
    if len(rules) > MAX_RULES:
        return _joined_rules(df, url, carry, df.sparkSession.createDataFrame(rules, "rule string, verdict string"))
    found = Rules(rules)

    def judge(urls: list[str | None]) -> list[pa.Array]:
        parsed = [parse(u) for u in urls]
        hits = [found.find(*p) for p in parsed]
        return [pa.array([x[i] for x in xs], pa.string()) for xs in (parsed, hits) for i in (0, 1)]

    return _judged(df, url, carry, dict.fromkeys(_RULED, T.StringType()), judge)


def _joined_rules(df: DataFrame, url: str, carry: list[str], rules: DataFrame) -> DataFrame:
    """Rules met by a join: each distinct host and path looks up its host's suffixes, and the longest fitting rule comes back."""

    def judge(urls: list[str | None]) -> list[pa.Array]:
        parsed = [parse(u) for u in urls]
        return [pa.array([p[i] for p in parsed], pa.string()) for i in (0, 1)]

    keep = [c for c in carry if c not in _RULED]
    shield = [f"__c{i}" for i in range(len(keep))]
    parsed = _judged(df.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(keep, shield, strict=True)), F.col(url).alias("__u")), "__u", shield, dict.fromkeys(_RULED[:2], T.StringType()), judge)
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    asked = parsed.select("host", "path").distinct().withColumn("__suffix", suffix)
    table = rules.select("rule", "verdict", F.substring_index("rule", "/", 1).alias("__host"), F.substr("rule", F.length(F.substring_index("rule", "/", 1)) + 1).alias("__start"))
    start = F.when(F.col("__start") == "", F.lit("/")).otherwise(F.col("__start"))
    met = asked.join(table, F.col("__suffix") == F.col("__host")).where(F.startswith("path", start))
    best = met.groupBy(F.col("host").alias("__h"), F.col("path").alias("__p")).agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict")).alias("best"))
    out = parsed.join(best, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left")
    return out.select(*(F.col(x).alias(c) for c, x in zip(keep, shield, strict=True)), "host", "path", "best.rule", "best.verdict")


def train(urls: list[str | None], blocked: list[bool], *, folds: int = FOLDS, **options) -> tuple[Lexical, Boosted]:
    """Suffix statistics of all URLs, and trees grown on features whose statistics leave out the URL's fold."""
    y = np.array(blocked, float)
    lexical = Lexical()
    lexical.fit(urls, y)
    if not len(y):
        return lexical, Boosted(start=-20.0)
    fold = np.array([zlib.crc32((u or "").encode("utf-8", "replace")) % folds for u in urls])
    x = lexical.matrix(urls)
    for f in np.unique(fold):
        others, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        rest = Lexical()
        rest.fit([urls[i] for i in others], y[others])
        x[own] = rest.matrix([urls[i] for i in own])
    return lexical, Boosted(**options).fit(x, y)


def filter_urls(df: DataFrame, url: str, carry: list[str], rules: list[tuple[str, str]] | DataFrame, *, max_rows: int = MAX_ROWS) -> DataFrame:
    """Columns ``carry`` with ``host``, ``path``, ``rule``, ``verdict`` and ``p_block``.

    The trees learn from the URLs that rules decide.
    """
    labelled = apply_rules(df.select(F.col(url).alias("__u")), "__u", ["__u"], rules).where("verdict is not null")
    taken = smallest(labelled.select("__u", "verdict"), F.col("__u"), ["__u", "verdict"], max_rows)
    lexical, model = train([r[0] for r in taken], [r[1] == "block" for r in taken])
    keep = [c for c in carry if c not in (*_RULED, "p_block")]
    shield = [f"__c{i}" for i in range(len(keep))]
    rows = df.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(keep, shield, strict=True)), F.col(url).alias("__u"))
    ruled = apply_rules(rows, "__u", [*shield, "__u"], rules)

    def judge(urls: list[str | None]) -> list[pa.Array]:
        return [pa.array(model.predict(lexical.matrix(urls)), pa.float64())]

    out = _judged(ruled, "__u", [*shield, *_RULED], {"p_block": T.DoubleType()}, judge)
    verdict = F.coalesce("verdict", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return out.select(*(F.col(x).alias(c) for c, x in zip(keep, shield, strict=True)), "host", "path", "rule", verdict.alias("verdict"), "p_block")


OP4_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op4_urls(spark, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, else by the trees; a null URL has an empty host and path and no rule."""
    pages = spread(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return filter_urls(pages, "url", ["page_id"], OP4_RULES)
