"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language.  A word's score for a language
adds learned weights of its affixes, character n-grams and itself (the lexicon
feature), hashed into a fixed table.  A word of more than ``PIECE`` letters, such
as a text in a script without spaces, is labelled piece by piece: the n-grams
that begin in a piece are its own, the first has the word's prefixes and the word
itself, the last its suffixes.  Learned transitions say how languages
follow each other; forward-backward gives each word's marginals.  A document
gets the language with the largest sum of marginals, and that sum's share as
its score, so that a passage in another language counts for what it is.

The field is trained on the driver from a bounded sample: ``max_rows`` labelled
texts of ``max_chars`` characters at most, those with the smallest hashes.
Training sequences splice pieces of texts in different languages, so the
transitions see switches.  Predicting covers every whole text: a chain is cut
into blocks whose transfer matrices are multiplied, which is exact and lets
numpy run all blocks of a batch at once.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without any labelled text all are ``und``; a null id counts as an empty one;
every row gives one row; columns named like an output are replaced.
"""

from __future__ import annotations

import itertools
import random
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.llm.sampling import smallest
from dockmill.plans.shared import spread

N_BUCKETS = 1 << 16
BLOCK = 64
PIECE = 40
BATCH_WORDS = 300_000
MEMO_WORDS = 600_000
MEMO_GRAMS = 200_000
MAX_ROWS = 1500
MAX_CHARS = 20_000


def core(token: str) -> str:
    """The letters of a token, lower-cased."""
    return (token if token.isalpha() else "".join(filter(str.isalpha, token))).lower()


class Piece(NamedTuple):
    """Of a long word: the letters with the two after them, how many are its own, and the word's ends where it has them."""

    letters: str
    own: int
    head: str
    tail: str
    word: str


def positions(token: str) -> list[str | Piece]:
    """What is labelled of a token: the token, or the pieces of a long word."""
    if len(token) <= PIECE or len(word := core(token)) <= PIECE:
        return [token]
    last = (len(word) - 1) // PIECE * PIECE
    return [Piece(word[i : i + PIECE + 2], min(PIECE, len(word) - i), word[:3] if i == 0 else "", word[-3:] if i == last else "", word if i == 0 else "") for i in range(0, len(word), PIECE)]


def split(text: str) -> list[str | Piece]:
    tokens = text.split()
    if max(map(len, tokens), default=0) <= PIECE:
        return tokens
    return list(itertools.chain.from_iterable(map(positions, tokens)))


class _Buckets(dict):
    """Buckets of the short n-grams of one kind, remembered up to a bound."""

    def __init__(self, kind: str):
        self.kind = kind

    def __missing__(self, gram: str) -> int:
        if len(self) >= MEMO_GRAMS:
            self.clear()
        self[gram] = found = bucket(self.kind + gram)
        return found


def bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) & (N_BUCKETS - 1)


_prefix, _suffix, _two, _three = map(_Buckets, "psbt")


def features(word: str | Piece) -> list[int]:
    """Hashed affixes, inner n-grams and the word itself."""
    w, own, head, tail, whole = word if isinstance(word, Piece) else (word, len(word), word[:3], word[-3:], word)
    out = [_prefix[head[:n]] for n in range(1, len(head) + 1)] + [_suffix[tail[-n:]] for n in range(1, len(tail) + 1)]
    out += [_two[w[i : i + 2]] for i in range(min(own, len(w) - 1))] + [_three[w[i : i + 3]] for i in range(min(own, len(w) - 2))]
    if whole:
        out.append(bucket("w" + whole))
    return out


class Field:
    """Weights of a trained field; scores of words are remembered up to a bound."""

    def __init__(self, labels: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.labels, self.weights, self.transitions = labels, weights, transitions
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str | Piece, int] = {}  # of tokens as written
        self.cores: dict[str | Piece, int] = {"": 0}  # of what is scored of them
        self.table, self.n = np.zeros((1024, len(self.labels)), np.float32), 1  # row 0: tokens without letters

    def __reduce__(self):
        return Field, (self.labels, self.weights, self.transitions)

    def lookup(self, texts: list[list[str | Piece]]) -> list[np.ndarray]:
        """Rows of ``table`` for the tokens of each text."""
        if len(self.rows) > MEMO_WORDS:
            self.forget()
        rows, cores = self.rows, self.cores
        flat, ends, at = [], [], self.n
        for token in set().union(*texts).difference(rows):
            word = token if isinstance(token, Piece) else core(token)
            row = cores.get(word)
            if row is None:
                row = cores[word] = at + len(ends)
                flat += features(word)
                ends.append(len(flat))
            rows[token] = row
        if ends:
            self.n += len(ends)
            if self.n > len(self.table):
                larger = np.zeros((2 * self.n, len(self.labels)), np.float32)
                larger[:at] = self.table[:at]
                self.table = larger
            self.table[at : self.n] = np.add.reduceat(self.weights[np.array(flat)], np.array([0, *ends[:-1]]), axis=0)
        return [np.fromiter(map(rows.__getitem__, tokens), np.int64, len(tokens)) for tokens in texts]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(label, score) of each text, some ``BATCH_WORDS`` words at a time."""
        out: list[tuple[str, float]] = []
        batch: list[list[str | Piece]] = []
        size = 0
        for tokens in map(split, texts):
            batch.append(tokens)
            size += len(tokens)
            if size > BATCH_WORDS:
                out += self._batch(batch)
                batch, size = [], 0
        return out + self._batch(batch)

    def _batch(self, texts: list[list[str | Piece]]) -> list[tuple[str, float]]:
        rows = self.lookup(texts)
        with_letters = [np.flatnonzero(r) for r in rows]
        rows = [r[k] for r, k in zip(rows, with_letters, strict=True)]  # tokens without letters say nothing and are left out
        alive = [i for i, r in enumerate(rows) if len(r)]
        out = [("und", 0.0)] * len(texts)
        if alive and self.labels:
            share = marginal_shares(self.table, self.transitions, [rows[i] for i in alive])
            for i, p in zip(alive, share, strict=True):
                k = int(p.argmax())
                out[i] = self.labels[k], float(min(1.0, max(0.0, p[k])))
        return out


def _normal(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def marginal_shares(table: np.ndarray, transitions: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Mean of the words' marginals of each text, by exact forward-backward in blocks."""
    k = len(transitions)
    step = np.exp(transitions).astype(np.float64)
    sizes = np.array([len(r) for r in rows])
    blocks = -(-sizes // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    n = first[-1]
    index, mask = np.zeros(n * BLOCK, np.int64), np.zeros(n * BLOCK, bool)
    for r, b in zip(rows, first[:-1], strict=True):
        index[b * BLOCK : b * BLOCK + len(r)] = r
        mask[b * BLOCK : b * BLOCK + len(r)] = True
    score = table[index].astype(np.float64)
    local = np.exp(score - score.max(axis=1, keepdims=True)).reshape(n, BLOCK, k) + 1e-30
    mask = mask.reshape(n, BLOCK)

    # What a block does to any incoming message.
    through = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(BLOCK):
        on = mask[:, t]
        new = (through[on] @ step) * local[on, t][:, None, :]
        through[on] = new / new.sum(axis=(1, 2), keepdims=True)

    # Messages at the blocks' borders, all texts at once.
    ahead, behind = np.full((n, k), 1 / k), np.full((n, k), 1 / k)
    for c in range(1, int(blocks.max())):
        at = first[:-1][blocks > c] + c
        ahead[at] = _normal(np.einsum("ni,nij->nj", ahead[at - 1], through[at - 1]))
    for c in range(1, int(blocks.max())):
        at = first[1:][blocks > c] - 1 - c
        behind[at] = _normal(np.einsum("nij,nj->ni", through[at + 1], behind[at + 1]))

    # Inside the blocks.
    alpha = np.empty((n, BLOCK, k))
    a = ahead
    for t in range(BLOCK):
        on = mask[:, t][:, None]
        a = np.where(on, _normal((a @ step) * local[:, t]), a)
        alpha[:, t] = a
    total, b = np.zeros((n, k)), behind
    for t in range(BLOCK - 1, -1, -1):
        on = mask[:, t][:, None]
        total += np.where(on, _normal(alpha[:, t] * b), 0)
        b = np.where(on, _normal((b * local[:, t]) @ step.T), b)
    return np.add.reduceat(total, first[:-1], axis=0) / sizes[:, None]


def train(samples: list[tuple[str, str]], *, steps: int = 250, width: int = 48, length: int = 80, rate: float = 0.3, seed: int = 8) -> Field:
    """Fit weights and transitions by stochastic gradient on the field's likelihood."""
    labels = sorted({label for _, label in samples})
    k, rng = len(labels), random.Random(seed)
    field = Field(labels, np.zeros((N_BUCKETS, k), np.float32), np.zeros((k, k)))
    by_label: dict[int, list[list[str | Piece]]] = {}
    for text, label in samples:
        if words := [w for x in split(text) if (w := x if isinstance(x, Piece) else core(x))]:
            by_label.setdefault(labels.index(label), []).append(words)
    if len(by_label) < 2:
        return field
    memo: dict[str | Piece, list[int]] = {}
    seen_w, seen_t = np.full_like(field.weights, 1e-6), np.full((k, k), 1e-6)
    kinds = sorted(by_label)
    for _ in range(steps):
        flat, ends, gold = [], [], []
        for _ in range(width):
            words: list[str | Piece] = []
            tags: list[int] = []
            while len(words) < length:
                y = rng.choice(kinds)
                text = rng.choice(by_label[y])
                size = rng.choice((3, 8, 20, 60))
                at = rng.randrange(max(1, len(text) - size + 1))
                words += text[at : at + size]
                tags += [y] * len(text[at : at + size])
            gold.append(tags[:length])
            for w in words[:length]:
                flat.extend(memo.get(w) or memo.setdefault(w, features(w)))
                ends.append(len(flat))
        flat, starts, gold = np.array(flat), np.array([0, *ends[:-1]]), np.array(gold)
        score = np.add.reduceat(field.weights[flat], starts, axis=0).reshape(width, length, k).astype(np.float64)
        grad_e, grad_t = _gradient(score, field.transitions, gold)
        grad_w = np.zeros_like(field.weights)
        np.add.at(grad_w, flat, np.repeat(grad_e.reshape(-1, k), np.diff([0, *ends]), axis=0).astype(np.float32))
        seen_w += grad_w**2
        seen_t += grad_t**2
        field.weights += rate * grad_w / np.sqrt(seen_w)
        field.transitions += rate * grad_t / np.sqrt(seen_t)
    return field


def _gradient(score: np.ndarray, transitions: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean log-likelihood of equally long sequences: by word and label, and by transition."""
    width, length, k = score.shape
    step = np.exp(transitions)
    local = np.exp(score - score.max(axis=2, keepdims=True)) + 1e-30
    alpha, beta = np.empty_like(local), np.empty_like(local)
    a = np.full((width, k), 1 / k)
    for t in range(length):
        a = alpha[:, t] = _normal((a @ step) * local[:, t])
    b = np.full((width, k), 1 / k)
    for t in range(length - 1, -1, -1):
        beta[:, t] = b
        b = _normal((b * local[:, t]) @ step.T)
    one = np.eye(k)[gold]
    pairs = alpha[:, :-1, :, None] * step * (local * beta)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    seen = np.einsum("nti,ntj->ij", one[:, :-1], one[:, 1:])
    return (one - _normal(alpha * beta)) / width, (seen - pairs.sum(axis=(0, 1))) / width


def sample(labelled: DataFrame, text: str, label: str, order: Column, *, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> list[tuple[str, str]]:
    """The ``max_rows`` labelled texts with the smallest hash of ``order``; texts travel once the bound is known."""
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= max_chars))
    return smallest(rows.select(F.col(text).alias("text"), F.col(label).alias("label"), order.alias("order")), F.col("order"), ["text", "label"], max_rows)


def predict_frame(df: DataFrame, text: str, carry: list[str], field: Field) -> DataFrame:
    """Columns ``carry`` with ``lang_pred`` and ``score``.  The field is N_BUCKETS weights a language, whatever the data."""
    shared = df.sparkSession.sparkContext.broadcast(field)
    rest = [f for f in df.schema.fields if f.name in carry and f.name not in ("lang_pred", "score")]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            got = list(itertools.chain.from_iterable(field.predict([t or "" for t in batch.column("__lid_text").slice(i, 500).to_pylist()]) for i in range(0, batch.num_rows, 500)))
            new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, names=[*names, "lang_pred", "score"])

    schema = T.StructType([*rest, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.select(*names, F.col(text).alias("__lid_text")).mapInArrow(run, schema)


def op8_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document by a field that learns outside the held-out third; a text without letters is ``und``."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    field = train(sample(docs.where(~held_out), "text", "lang", F.col("doc_id")))
    found = predict_frame(docs.select("doc_id", "text"), "text", ["doc_id"], field)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
