"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of its
encoding: the token t that ends there such that the pair (last token of the
prefix before t, t) is what BPE makes of those two tokens' bytes.  Storing that
token per prefix gives the encoding by walking back from the end; appending
bytes extends the table without touching it, and after an edit only entries
from the edit on are computed, until the table runs as before.  Which tokens can
end at a place is read off the last three bytes, so few lengths are tried.  The
tables of all new words of a batch of texts are computed together, over arrays
(``prefix_tables.py``).

Texts are first cut by the vocabulary's pattern and each match is encoded on
its own.  A word between two single spaces is cut the same way wherever it
stands, so its ids are remembered by word; texts with other white space around
words take the pattern over the whole text.

Defined results: a null text is an empty one and has no ids; white space,
control characters and unpaired surrogates' replacements are encoded as their
bytes, as everything is; every row gives one row, repeated rows too; an empty
table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dockmill.llm.memo import only, register
from dockmill.llm.prefix_tables import PrefixTables
from dockmill.plans.shared import spread

# The white space of the pattern's \s.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
MEMO_WORDS = 300_000  # in each of two generations
MEMO_PAIRS = 400_000
SHORT = 64
ARRAY_WORDS = 12_000
_NEVER = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class PrefixTable:
    """The last token's id for each prefix of a growing byte string."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Extend the string; entries there stay as they are."""
        start, self.data = len(self.data), self.data + data
        self.encoder.extend(self.data, self.last, start + 1, len(self.data) + 1)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes; returns how many entries were computed anew.

        Entries before the edit stay.  Behind it, once as many entries in a row
        as the longest token has bytes agree with the old table, all later ones do.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, agreed, computed = old[: start + 1], 0, 0
        for at in range(start + 1, len(self.data) + 1):
            if at > start + len(new) and agreed >= self.encoder.longest:
                self.last.extend(old[at - shift :])
                break
            self.encoder.extend(self.data, self.last, at, at + 1)
            computed += 1
            agreed = agreed + 1 if at > start + len(new) and self.last[at] == old[at - shift] else 0
        return computed

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= self.encoder.size_of[self.last[at]]
        return out[::-1]


class Encoder:
    """Encodes as the rank-based merging of BPE does, by :class:`PrefixTable`."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.vocabulary = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.size_of = {i: len(t) for i, t in self.vocabulary.items()}
        self.tails = _tails(ranks)
        self.digits = {i: str(i) for i in self.vocabulary}
        self.split = regex.compile(pattern).findall
        self.pairs: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict[int, list[int]], ...] = ({}, {})
        self.pieces = _Generations()
        self.words = _Words(self)
        self.tables: PrefixTables | None = None

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """Plain merging, lowest rank first, down to ``least`` parts: how a token is made."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        if token not in self.made_of:
            data = self.vocabulary[token]
            parts = self.merged(data, 2)
            if len(data) > 1 and (len(parts) != 2 or self.merged(data) != [token] or max(parts) >= token):
                raise ValueError("not a vocabulary in which each token is a merge of two earlier ones")
            self.made_of[token] = tuple(parts) if len(data) > 1 else None
        return self.made_of[token]

    def edge(self, token: int, side: int) -> list[int]:
        """The tokens at one edge (0 left, 1 right) as merging builds this one, from its byte up."""
        known = self.edges[side].get(token)
        if known is None:
            two = self.halves(token)
            known = self.edges[side][token] = [*(self.edge(two[side], side) if two else ()), token]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their bytes are encoded together.

        Merging works in rank order, so only the tokens that face each other
        across the border matter: both sides grow, the lower rank first (the left
        one of two equal merges), and the pair fits if no merge over the border
        ever comes before the next one on either side.
        """
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        ranks, vocabulary = self.ranks, self.vocabulary
        while True:
            up = a[i + 1] if i + 1 < len(a) else _NEVER
            down = b[j + 1] if j + 1 < len(b) else _NEVER
            over = ranks.get(vocabulary[a[i]] + vocabulary[b[j]], _NEVER)
            if over < up and over <= down and over != _NEVER:
                return False
            if up == down == _NEVER:
                return True
            if up <= down:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], first: int, stop: int) -> None:
        """Append to ``last`` the last tokens of the prefixes that end at first, ..., stop - 1."""
        token_of, known, tails = self.ranks.get, self.pairs, self.tails
        for end in range(first, stop):
            sizes = tails.get(data[end - 3 : end]) if end > 2 else None
            for size in sizes or tails.get(data[end - 2 : end] if end > 1 else b"", _BYTE):
                start = end - size
                if start < 0:
                    continue
                token = token_of(data[start:end])
                if token is None:
                    continue
                if start == 0:
                    break
                key = last[start] << 32 | token
                fits = known.get(key)
                if fits is None:
                    if len(known) >= MEMO_PAIRS:
                        known.clear()
                    fits = known[key] = self.fits(last[start], token)
                if fits:
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)

    def ids_of(self, data: bytes) -> tuple[int, ...]:
        token = self.ranks.get(data)
        return (token,) if token is not None else tuple(PrefixTable(self, data).ids())

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern; a space and a word are remembered with the words."""
        if piece[0] == " " and piece[1:2] not in WHITE and len(piece) > 1:
            return self.words.of_piece(piece)
        known = self.pieces.find(piece)
        if known is None:
            known = self.ids_of(piece.encode("utf-8", "replace"))
            self.pieces.keep(piece, known)
        return known

    def learn(self, texts: list[list[str]]) -> None:
        """Remember the ids of all words of the texts (cut at spaces) that are not known yet, their tables computed together."""
        words = self.words
        fresh = set().union(*texts).difference(words)
        again = {w: words.older[w] for w in fresh & words.older.keys()}
        words.keep_all(again)
        new = [w for w in fresh.difference(again) if 0 < len(w) <= SHORT and w[0] not in WHITE and w[-1] not in WHITE]
        if self.tables is None:
            self.tables = PrefixTables(self.ranks, self.fits, MEMO_PAIRS)
        for at in range(0, len(new), ARRAY_WORDS):
            part = new[at : at + ARRAY_WORDS]
            joined = " " + " ".join(part)
            sizes = np.fromiter((len(p) for p in self.split(joined)), np.int64)
            data = joined.encode("utf-8", "replace")
            if len(data) > len(joined):  # from characters to bytes
                byte_of = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
                sizes = np.diff(byte_of[np.concatenate([[0], np.cumsum(sizes)])])
            words.keep_all(dict(zip(part, self.tables.encode(data, sizes), strict=True)))

    def encode(self, text: str) -> list[int]:
        return self.encode_cut(text, text.split(" "))

    def encode_cut(self, text: str, words: list[str]) -> list[int]:
        """Ids of a text that was cut at its spaces."""
        first = words[0]
        try:
            if first and (first[0] in WHITE or first[-1] in WHITE):
                raise _Irregular
            out = self.plain(first) if first or len(words) == 1 else []
            out.extend(chain.from_iterable(map(self.words.__getitem__, islice(words, 1, None))))
            return out
        except _Irregular:
            return self.plain(text)

    def plain(self, text: str) -> list[int]:
        """Ids of a text by the pattern over all of it."""
        words, out = self.words, []
        for piece in self.split(text):
            if piece[0] == " " and len(piece) > 1 and piece[1] not in WHITE:
                out.extend(words[piece[1:]])
            else:
                out.extend(self.piece(piece))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


class _Irregular(Exception):
    """White space beside a space: the cut depends on the neighbours."""


class _Generations(dict):
    """A bounded memory: when it is full, it becomes the older generation and the one before that is forgotten."""

    def __init__(self) -> None:
        self.older: dict[str, tuple[int, ...]] = {}

    def find(self, key: str) -> tuple[int, ...] | None:
        known = self.get(key)
        if known is None and (known := self.older.get(key)) is not None:
            self.keep(key, known)
        return known

    def keep(self, key: str, ids: tuple[int, ...]) -> None:
        if len(key) <= SHORT:
            if len(self) >= MEMO_WORDS:
                self.older = self.copy()
                self.clear()
            self[key] = ids

    def keep_all(self, known: dict[str, tuple[int, ...]]) -> None:
        """Like :meth:`keep`, of keys that are short."""
        if len(self) + len(known) > MEMO_WORDS:
            self.older = self.copy()
            self.clear()
        self.update(known)


class _Words(_Generations):
    """Ids of a space and the word after it, by word."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            if not word or word[0] in WHITE or word[-1] in WHITE:
                raise _Irregular
            pieces = self.encoder.split(" " + word)
            if len(pieces) == 1:
                return self.of_piece(pieces[0])
            ids = tuple(chain.from_iterable(map(self.encoder.piece, pieces)))
        self.keep(word, ids)
        return ids

    def of_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a space and a word that are one match of the pattern."""
        ids = self.find(piece[1:])
        if ids is None:
            ids = self.encoder.ids_of(piece.encode("utf-8", "replace"))
            self.keep(piece[1:], ids)
        return ids


_BYTE = (1,)


def _tails(ranks: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
    """By the last three (or two) bytes: the lengths of the tokens that end so, longest first."""
    found: dict[bytes, set[int]] = {}
    for token in ranks:
        if len(token) > 1:
            found.setdefault(token[-3:], {1}).add(len(token))
    for tail, sizes in found.items():
        if tail[-2:] in ranks:
            sizes.add(2)
    same: dict[tuple[int, ...], tuple[int, ...]] = {}
    return {tail: same.setdefault(t := tuple(sorted(sizes, reverse=True)), t) for tail, sizes in found.items()}


class EncodedText:
    """A text with its pieces' ids, kept up to date under appends and edits."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.pieces, self.ids_of = encoder, [], []
        self.replace(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def append(self, text: str) -> int:
        n = sum(map(len, self.pieces))
        return self.replace(n, n, text)

    def replace(self, start: int, end: int, new: str) -> int:
        """Replace characters; returns how many pieces were encoded anew.

        Cutting starts over two pieces before the edit (a piece's end depends on
        what follows it by one character beyond its white space at most) and stops
        where it meets an old cut behind the edit.
        """
        starts = [0]
        for p in self.pieces:
            starts.append(starts[-1] + len(p))
        first = max(0, sum(s <= start for s in starts[:-1]) - 3)
        while first and self.pieces[first].isspace():
            first -= 1
        text = self.text
        tail = text[starts[first] : start] + new + text[end:]
        shift, at = len(new) - (end - start), starts[first]
        old = {s + shift: k for k, s in enumerate(starts) if s >= end}
        fresh, rest = [], len(self.pieces)
        for m in regex.compile(self.encoder.split.__self__.pattern).finditer(tail):
            here = at + m.start()
            if here in old and here > start + len(new) and fresh and not fresh[-1].isspace():
                rest = old[here]
                break
            fresh.append(m.group())
        self.pieces[first:rest] = fresh
        self.ids_of[first:rest] = [self.encoder.piece(p) for p in fresh]
        return len(fresh)

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.ids_of))


_encoders: dict[tuple[str, str], Encoder] = {}
register("bpe", _encoders.clear)
SLICE = 1000


def encoder_of(data: bytes, pattern: str) -> Encoder:
    """One encoder a worker process and vocabulary, with its memory of words."""
    key = hashlib.sha256(data).hexdigest(), pattern
    if key not in _encoders:
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


def encode_frame(df: DataFrame, text: str, vocabulary: str, pattern: str, *, ids: bool = True) -> DataFrame:
    """``df`` without ``text`` and with ``n_tokens``, ``token_ids``, ``ids_sha256`` and ``decoded_sha256``.

    ``vocabulary``: a ``.tiktoken`` file that the driver reads; its bytes (about
    1 MB, whatever the data) are broadcast.  ``decoded_sha256`` is of the bytes
    that the ids decode to.  ``ids=False`` leaves the ids themselves out.
    """
    with open(vocabulary, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()} | ({"token_ids": T.ArrayType(T.IntegerType(), False)} if ids else {})
    rest = [f for f in df.schema.fields if f.name != text and f.name not in made]
    schema = T.StructType([*rest, *(T.StructField(k, v) for k, v in made.items())])
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("bpe")
        gc.disable()  # millions of small tuples and no cycles
        encoder = encoder_of(shared.value, pattern)
        sha, digits = hashlib.sha256, encoder.digits.__getitem__
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            columns: dict[str, list] = {k: [] for k in made}
            texts = [t or "" for t in batch.column(text).to_pylist()]
            cut = [t.split(" ") for t in texts]
            encoder.learn(cut)
            for t, words in zip(texts, cut, strict=True):
                found = encoder.encode_cut(t, words)
                columns["n_tokens"].append(len(found))
                columns["ids_sha256"].append(sha(" ".join(map(digits, found)).encode()).hexdigest())
                columns["decoded_sha256"].append(sha(encoder.decode(found)).hexdigest())
                if ids:
                    columns["token_ids"].append(pa.array(found, pa.int32()))
            new = [pa.array(columns[k], pa.int64() if k == "n_tokens" else pa.list_(pa.int32()) if k == "token_ids" else pa.string()) for k in made]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, names=[*names, *made])
        gc.enable()

    return df.select(*names, text).mapInArrow(run, schema)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of every document, and the digest of what they decode to; a null text is an empty one."""
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return encode_frame(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)
