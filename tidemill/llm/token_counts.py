"""Token counts by rank-synchronous array merging of byte pairs.

Pre-tokens of a batch are held as one ragged array of symbol numbers. In each round every
sequence finds its lowest-ranked adjacent pair, and all sequences apply theirs at once; the
array shrinks until no sequence has a pair with a rank. What is counted is the symbols left.
Pre-tokens repeat, so each task keeps the counts it has found, up to a bound.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 512
# Known pre-tokens a task keeps before it starts anew; bounds its memory, not its results.
KNOWN = 400_000
_NONE = np.int64(1) << 40

# Fixed value: how byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter byte-level vocabularies write for each byte: itself where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in prints}
    hidden = (b for b in range(256) if b not in set(prints))
    return letters | {chr(256 + n): b for n, b in enumerate(hidden)}


class Merges:
    """Ranks of symbol pairs: symbols 0 to 255 are bytes, 256 + r is the result of rank r."""

    def __init__(self, pairs: list[tuple[int, int]], results: list[int], specials: list[str]):
        size = 1 << (4 * len(pairs)).bit_length()
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int64)
        self.results = np.array(results, np.int64)
        self.longest = 0
        for rank, (a, b) in enumerate(pairs):
            key = a << 32 | b
            at = int(self._slot(np.array([key]))[0])
            steps = 0
            while self.keys[at] >= 0 and self.keys[at] != key:
                at = (at + 1) & (size - 1)
                steps += 1
            if self.keys[at] < 0:
                self.keys[at], self.ranks[at] = key, rank
            self.longest = max(self.longest, steps)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.split = regex.compile(PATTERN)

    @classmethod
    def read(cls, path: str) -> Merges:
        """From a byte-level vocabulary file in JSON: merges, and special strings."""
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        letters = _byte_letters()
        number = {letter: byte for letter, byte in letters.items()}
        pairs, results = [], []
        for rank, pair in enumerate(known["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs.append((number[a], number[b]))
            number.setdefault(a + b, 256 + rank)
            results.append(number[a + b])
        return cls(pairs, results, [t["content"] for t in known["added_tokens"]])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24) & self.mask).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self._slot(keys)
        ranks = np.where(self.keys[at] == keys, self.ranks[at], _NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        for _ in range(self.longest):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & int(self.mask)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            ranks[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return ranks

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each byte sequence after all merges."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        total = lengths.copy()
        symbol = np.frombuffer(b"".join(sequences), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(sequences)), lengths)
        joined = np.append(owner[1:] == owner[:-1], False)
        rank = np.full(len(symbol), _NONE, np.int64)
        inner = np.flatnonzero(joined)
        rank[inner] = self.rank(symbol[inner], symbol[inner + 1])
        while len(symbol):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(owner)))
            alive = least < _NONE
            if not alive.all():
                total[owner[heads[~alive]]] = sizes[~alive]
                keep = np.repeat(alive, sizes)
                symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
                if not len(symbol):
                    break
                least, sizes = least[alive], sizes[alive]
            chosen = rank == np.repeat(least, sizes)
            at = np.flatnonzero(chosen)
            # In a run such as "aaa" pairs overlap: from the left, every second one is applied.
            run = np.append(True, at[1:] != at[:-1] + 1)
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            symbol[at] = self.results[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            touched = place[at]
            touched = np.unique(np.concatenate((touched, np.maximum(touched - 1, 0))))
            rank[touched] = _NONE
            touched = touched[touched < len(symbol) - 1]
            touched = touched[owner[touched] == owner[touched + 1]]
            rank[touched] = self.rank(symbol[touched], symbol[touched + 1])
        return total


class Counter:
    """Token counts of texts; remembers pre-tokens it has met."""

    def __init__(self, merges: Merges, known: int = KNOWN):
        self.merges, self.bound = merges, known
        self.known: dict[str, int] = {}

    def count(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text, NULL as empty; a special string is one token."""
        pieces, extra = [], []
        for text in texts:
            special = self.merges.specials
            parts = special.split(text) if text and special else [text or ""]
            extra.append(len(parts) - 1)
            pieces.append([p for part in parts for p in self.merges.split.findall(part)])
        fresh = set().union(*pieces).difference(self.known)
        if len(self.known) + len(fresh) > self.bound:
            self.known.clear()
            fresh = set().union(*pieces)
        words = list(fresh)
        counts = self.merges.count([w.encode() for w in words])
        self.known.update(zip(words, counts.tolist(), strict=True))
        look = self.known.__getitem__
        return [n + sum(map(look, tokens)) for n, tokens in zip(extra, pieces, strict=True)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per task process and vocabulary."""
    return Counter(Merges.read(path))


def token_count(text: str | Column, path: str) -> Column:
    """Number of tokens of ``text`` under the vocabulary file at ``path`` on each machine."""

    @F.arrow_udf("long")
    def tokens(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path).count
        for column in columns:
            found: list[int] = []
            part: list[str | None] = []
            size = 0
            for value in column:
                part.append(value.as_py())
                size += len(part[-1] or "")
                if size > 1 << 20:
                    found += count(part)
                    part, size = [], 0
            yield pa.array(found + count(part), pa.int64())

    return tokens(text)


def count_tokens(documents: DataFrame, path: str, *, limit: int = LIMIT) -> DataFrame:
    """``documents`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    A NULL or empty text has no bytes and no tokens. Each of several equal rows is counted. An
    empty table gives an empty result. Columns of the new names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.withColumns(
        {"n_bytes": F.octet_length(text).cast("long"), "n_tokens": token_count("text", path)}
    ).withColumn("over_limit", F.col("n_tokens") > limit)
