"""Byte-pair merging of many short words at once, in numpy.

Every word of a batch is a row of symbols with links to its neighbours. Each
round finds each row's best-ranked pair (the leftmost of equals), merges it and
ranks the two pairs that changed, so a round costs one pass over the live rows
and a word needs as many rounds as it has merges.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

_NONE = np.int32(2**31 - 1)


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others take the letters
    from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class MergeTable:
    """A vocabulary's merges as an open-addressing table from pair to rank."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.size = 1 + max([*self.vocab.values(), *self.special.values()])
        letters = byte_letters()
        self.first = np.array([self.vocab[c] for c in letters], np.int32)
        self.last = np.array([self.vocab[c + self.suffix] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([self.vocab[b] for _, b in merges], np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in merges], np.int32)
        back = {c: b for b, c in enumerate(letters)}
        self.token_bytes: dict[int, bytes] = {i: bytes(back[c] for c in t.removesuffix(self.suffix)) for t, i in self.vocab.items()}
        self._fill()

    def _fill(self) -> None:
        bits = 18
        while 1 << bits < 3 * len(self.made):
            bits += 1
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        keys = self.left * self.size + self.right
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            _, winner = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            winner = winner[free[winner]]
            self.keys[at[winner]] = keys[todo[winner]]
            self.ranks[at[winner]] = todo[winner]
            rest = np.ones(len(todo), bool)
            rest[winner] = False
            todo, at = todo[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b); _NONE where they don't merge or a side is missing (-1)."""
        keys = a.astype(np.int64) * self.size + b
        keys[(a < 0) | (b < 0)] = -2
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], _NONE)
        left = np.flatnonzero((found != keys) & (found != -1) & (keys >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.ranks[at[left[hit]]]
            left = left[~hit & (found != -1)]
        return out

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The token ids of each word, as int32 arrays."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        start = int(np.searchsorted(lengths[order], 1))
        while start < len(order):
            longest = int(lengths[order[start]])
            longest = longest if longest <= 16 else -(-longest // 8) * 8
            stop = min(int(np.searchsorted(lengths[order], longest, side="right")), start + max(1, (1 << 20) // longest))
            part = order[start:stop]
            for i, ids in zip(part.tolist(), self._merge([words[i] for i in part.tolist()], lengths[part], int(lengths[part[-1]]))):
                out[i] = ids
            start = stop
        return out

    def _merge(self, words: list[bytes], lengths: np.ndarray, wide: int) -> list[np.ndarray]:
        n = len(words)
        inside = np.arange(wide) < lengths[:, None]
        symbols = np.full((n, wide + 1), -1, np.int32)
        symbols[:, :wide][inside] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        if self.suffix:
            symbols[np.arange(n), lengths - 1] = self.last[np.fromiter((w[-1] for w in words), np.uint8, n)]
        ranks = np.full((n, wide + 1), _NONE, np.int32)
        ranks[:, :-1] = self.rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, wide)
        # Column wide is a blank that ends every row; the blank before column 0 is column -1, the same one.
        after = np.tile(np.arange(1, wide + 2, dtype=np.int32), (n, 1))
        after[:, -1] = wide
        before = np.tile(np.arange(-1, wide, dtype=np.int32), (n, 1))
        before[:, 0] = wide
        live = np.arange(n)
        while len(live):
            best = ranks[live].argmin(1) if len(live) < n else ranks.argmin(1)
            rank = ranks[live, best]
            going = rank < _NONE
            live, best, rank = live[going], best[going], rank[going]
            if not len(live):
                break
            gone = after[live, best]
            nxt, prev = after[live, gone], before[live, best]
            symbols[live, best] = self.made[rank]
            symbols[live, gone] = -1
            ranks[live, gone] = _NONE
            after[live, best] = nxt
            before[live, nxt] = best
            here = symbols[live, best]
            ranks[live, best] = self.rank(here, np.where(nxt < wide, symbols[live, nxt], -1))
            ranks[live, prev] = np.where(prev < wide, self.rank(np.where(prev < wide, symbols[live, prev], -1), here), _NONE)
        kept = symbols[:, :wide] >= 0
        return np.split(symbols[:, :wide][kept], np.cumsum(kept.sum(1))[:-1])
