"""Prefix tables of many short byte strings at once, over arrays.

The same dynamic program as :class:`dockmill.llm.bpe.PrefixTable`: for each
prefix of each string, the one token that can be the last of its encoding.
A trie gives every token that starts at every byte, one depth for all bytes at
a time; then the prefixes' last tokens follow, one length for all strings at a
time, since they depend on shorter prefixes only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_EMPTY = -1


class LongTable:
    """Non-negative longs to ints, by open addressing; holds ``limit`` keys and starts over beyond that."""

    def __init__(self, limit: int):
        self.limit, self.n = limit, 0
        self.bits = max(4, (4 * limit - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        self.n = 0
        self.keys, self.values = np.full(1 << self.bits, _EMPTY, np.int64), np.zeros(1 << self.bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 for keys that are not there."""
        at = self._slots(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        at = at[open_]
        while len(open_):
            at = (at + 1) & (len(self.keys) - 1)
            seen = self.keys[at]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (seen != _EMPTY)
            open_, at = open_[on], at[on]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there."""
        if self.n + len(keys) > self.limit:
            self.clear()
            keys, values = keys[: self.limit], values[: self.limit]
        self.n += len(keys)
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == _EMPTY)
            self.keys[at[free]] = keys[free]  # of several keys for a slot the last one stays
            placed = np.zeros(len(keys), bool)
            placed[free] = self.keys[at[free]] == keys[free]
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & (len(self.keys) - 1)


class PrefixTables:
    """Encodes byte strings with a vocabulary; ``fits(left, right)`` says whether two tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int], fits: Callable[[int, int], bool], max_pairs: int):
        self.fits = fits
        nodes: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        edges: list[tuple[int, int]] = []
        for token in ranks:
            for n in range(2, len(token) + 1):
                if token[:n] not in nodes:
                    edges.append((nodes[token[: n - 1]] << 8 | token[n - 1], len(nodes)))
                    nodes[token[:n]] = len(nodes)
        self.trie = LongTable(max(1, len(edges)))
        self.trie.add(*np.array(edges, np.int64).reshape(-1, 2).T)
        self.token_of = np.full(len(nodes), -1, np.int64)
        self.size_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.token_of[nodes[token]] = rank
            self.size_of[rank] = len(token)
        self.pairs = LongTable(max_pairs)
        self.numbers = np.array(range(len(self.size_of)), object)  # one number object an id, not one a token

    def _candidates(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, token) of every token in the strings; ``room``: bytes from each to its string's end."""
        at, node = np.arange(len(data)), data.astype(np.int64)
        found, size = [], 1
        while len(at):
            token = self.token_of[node]
            is_one = token >= 0
            found.append((at[is_one], np.full(int(is_one.sum()), size), token[is_one]))
            on = room[at] > size
            at, node = at[on], node[on]
            node = self.trie.find(node << 8 | data[at + size])
            at, node, size = at[node >= 0], node[node >= 0], size + 1
        starts, sizes, tokens = zip(*found)
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(tokens)

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        fits = self.pairs.find(keys)
        new = np.unique(keys[fits < 0])
        if len(new):
            values = np.array([self.fits(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], np.int32)
            fits[fits < 0] = values[np.searchsorted(new, keys[fits < 0])]
            self.pairs.add(new, values)
        return fits > 0

    def encode(self, joined: bytes, sizes: np.ndarray) -> list[tuple[int, ...]]:
        """Ids of words that each begin with the one space that they have.

        ``sizes``: bytes of the strings that are encoded on their own, one or more a word.
        """
        data = np.frombuffer(joined, np.uint8)
        stops = np.cumsum(sizes)
        starts = stops - sizes
        begin = np.repeat(starts, sizes)
        room = np.repeat(stops, sizes) - np.arange(len(data))
        at, size, token = self._candidates(data, room)
        length = at + size - begin[at]  # of the prefix that the token ends
        order = np.argsort(length.astype(np.int16 if sizes.max() < 1 << 15 else np.int64), kind="stable")
        at, size, token = at[order], size[order], token[order]
        cuts = np.searchsorted(length[order], np.arange(1, int(sizes.max()) + 2))
        last = np.full(len(data), -1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, n, t = at[a:b], size[a:b], token[a:b]
            ok = s == begin[s]
            inner = np.flatnonzero(~ok)
            ok[inner] = self._fit(last[s[inner] - 1], t[inner])
            last[(s + n - 1)[ok]] = t[ok]
        if (last < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        ends, here, low = np.zeros(len(data), bool), stops - 1, starts
        while len(here):
            ends[here] = True
            here = here - self.size_of[last[here]]
            here, low = here[here >= low], low[here >= low]
        ids, before = self.numbers[last[ends]].tolist(), np.cumsum(ends) - ends
        cuts = [*before[data == 32].tolist(), len(ids)]
        return [tuple(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
