"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A first pass counts how often the n-grams of the test items occur in the corpus. Of every few
neighbouring n-grams of an item the rarest becomes a seed, so each stretch of an item has one,
however common it is. A second pass finds seeds in the documents, and the stretch of a document
around an item's seeds is aligned with the item, word by word: edits, insertions and omissions
lower the score, and a passage that shares only a phrase stays below the threshold.

Items are taken in parts of bounded size, each with its own two passes, so what a task holds
does not follow the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import ragged

SEED_WORDS = 3
# Neighbouring n-grams of an item of which the rarest is a seed.
WINDOW = 3
# An alignment counts from this share of the score of the whole item on.
SCORE = 0.5
# Bytes of test items that one pass looks for.
PART_BYTES = 8 << 20

_MATCH, _OTHER, _GAP = 2, -1, -1
_START_BITS = 24
_CELLS = 1 << 19


def align(items: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """(score, first, end) of the best local alignment of each item with its region.

    All pairs go through the table at once, a row per item word. A cell holds the score and,
    in the low bits, where its alignment begins; of equal scores the earlier begin counts.
    """
    found = np.zeros((len(items), 3), np.int64)
    order = sorted(range(len(items)), key=lambda k: len(regions[k]))
    one, low = np.int64(1) << _START_BITS, (np.int64(1) << _START_BITS) - 1
    k = 0
    while k < len(order):
        take = 1
        while k + take < len(order) and (take + 1) * len(regions[order[k + take]]) <= _CELLS:
            take += 1
        some = order[k : k + take]
        k += take
        width, height = max(len(regions[p]) for p in some), max(len(items[p]) for p in some)
        # Fillers differ from all words and from each other.
        region = np.zeros((take, width), np.uint64)
        item = np.ones((take, height), np.uint64)
        for row, p in enumerate(some):
            region[row, : len(regions[p])] = regions[p]
            item[row, : len(items[p])] = items[p]
        column = np.arange(width + 1)
        fresh = low - column
        slope = column * -_GAP * one
        above = np.broadcast_to(fresh, (take, width + 1)).copy()
        best, end = np.zeros(take, np.int64), np.zeros(take, np.int64)
        for r in range(height):
            same = region == item[:, r : r + 1]
            cell = np.broadcast_to(fresh, (take, width + 1)).copy()
            np.maximum(cell[:, 1:], above[:, :-1] + np.where(same, _MATCH, _OTHER) * one, out=cell[:, 1:])
            np.maximum(cell, above + _GAP * one, out=cell)
            above = np.maximum.accumulate(cell + slope, 1) - slope
            at = above.argmax(1)
            top = above[np.arange(take), at]
            better = top >> _START_BITS > best >> _START_BITS
            best[better], end[better] = top[better], at[better]
        found[some, 0] = best >> _START_BITS
        found[some, 1] = low - (best & low)
        found[some, 2] = end
    return found


class Items:
    """Words of test items, the n-grams they hold, and later the seeds among them."""

    def __init__(self, ids: list[int], texts: list[str]):
        batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
        self.ids, self.words = ids, []
        grams, owner, place = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, data, offsets in ragged.slices(batch, "text"):
            words = ragged.Words(ragged.LOWER[data], offsets)
            hashes = words.hashes()
            for low, high in zip(words.first[:-1], words.first[1:], strict=True):
                own = hashes[low:high]
                found = ragged.ngram_hashes(own, min(SEED_WORDS, len(own))) if len(own) else own
                grams.append(found)
                owner.append(np.full(len(found), len(self.words)))
                place.append(np.arange(len(found)))
                self.words.append(own)
        self.owner, self.place = np.concatenate(owner), np.concatenate(place)
        self.grams, self.gram = np.unique(np.concatenate(grams), return_inverse=True)
        self.short = sorted({min(SEED_WORDS, len(w)) for w in self.words if len(w)})
        self.use(np.ones(len(self.owner), bool))

    def use(self, chosen: np.ndarray) -> None:
        """Look only for the n-grams at the chosen positions of items."""
        at = np.flatnonzero(chosen)
        order = np.argsort(self.gram[at], kind="stable")
        self.hits_owner, self.hits_place = self.owner[at][order], self.place[at][order]
        self.hits_first = np.searchsorted(self.gram[at][order], np.arange(len(self.grams) + 1))
        self.maybe = np.zeros(1 << 20, bool)
        wanted = np.diff(self.hits_first) > 0
        self.maybe[(self.grams[wanted] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def seeds(self, times: np.ndarray) -> np.ndarray:
        """Positions that are the rarest of any ``WINDOW`` neighbouring ones of their item."""
        chosen = np.zeros(len(self.owner), bool)
        rarity = times[self.gram]
        bounds = np.searchsorted(self.owner, np.arange(len(self.words) + 1))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            for begin in range(low, max(high - WINDOW + 1, low + (high > low))):
                chosen[begin + rarity[begin : min(begin + WINDOW, high)].argmin()] = True
        return chosen

    def find(self, words: ragged.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, n-gram) of each wanted n-gram in a slice."""
        at, gram = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n in self.short:
            inside = ragged.ngram_starts(words.first, n)
            if not len(inside):
                continue
            runs = ragged.ngram_hashes(hashes, n)
            hit = inside[self.maybe[(runs[inside] & np.uint64((1 << 20) - 1)).astype(np.int64)]]
            place = np.minimum(np.searchsorted(self.grams, runs[hit]), len(self.grams) - 1)
            same = self.grams[place] == runs[hit]
            at.append(hit[same])
            gram.append(place[same])
        return np.concatenate(at), np.concatenate(gram)


def _leaks(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Per text of a slice the items found: best score, first word and end of each."""
    words = ragged.Words(ragged.LOWER[data], offsets)
    hashes = words.hashes()
    found: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    at, gram = items.find(words, hashes)
    times = items.hits_first[gram + 1] - items.hits_first[gram]
    if not times.sum():
        return found
    hit = np.repeat(items.hits_first[gram] - np.cumsum(times) + times, times) + np.arange(times.sum())
    at = np.repeat(at, times)
    item = items.hits_owner[hit]
    start = at - items.hits_place[hit]
    document = np.searchsorted(words.first, at, "right") - 1
    order = np.lexsort((start, item, document))
    item, start, document = item[order], start[order], document[order]
    length = np.fromiter(map(len, items.words), np.int64, len(items.words))[item]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (document[1:] != document[:-1]) | (start[1:] - start[:-1] > length[1:])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(item)) - 1
    slack = length[heads] // 2 + 1
    low = np.maximum(start[heads] - slack, words.first[document[heads]])
    high = np.minimum(start[tails] + length[heads] + slack, words.first[document[heads] + 1])
    aligned = align([items.words[i] for i in item[heads]], [hashes[a:b] for a, b in zip(low, high, strict=True)])
    best: dict[tuple[int, int], tuple] = {}
    for k, (points, first, end) in enumerate(aligned.tolist()):
        share = points / (_MATCH * int(length[heads[k]]))
        if share >= SCORE:
            d, i = int(document[heads[k]]), int(item[heads[k]])
            begin = int(low[k] - words.first[d])
            rank = (share, -begin - first, begin + first, begin + end)
            best[d, i] = max(best.get((d, i), rank), rank)
    for (d, i), (share, _, first, end) in sorted(best.items()):
        found[d].append({"item_id": items.ids[i], "score": share, "first_word": first, "end_word": end})
    return found


_FOUND = "array<struct<item_id:long,score:double,first_word:long,end_word:long>>"


def _parts(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers and texts of the items, in parts of about ``PART_BYTES``; items without words are left out."""
    known = benchmark.where(F.col("text").rlike(r"[^\x20\x09-\x0D]") & F.col("item_id").isNotNull())
    known = known.select(F.col("item_id").cast("long"), "text")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    for part in range(parts):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct().collect()
        if rows:
            rows.sort(key=lambda r: (r["item_id"], r["text"]))
            yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def _finder(items: Items) -> Column:
    @F.arrow_udf(_FOUND)
    def leaks(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
        )
        for column in texts:
            batch = pa.record_batch([column], ["text"])
            rows = [r for _, data, offsets in ragged.slices(batch, "text") for r in _leaks(items, data, offsets)]
            yield pa.array(rows, kind)

    return leaks("text")


def _seeded(documents: DataFrame, ids: list[int], texts: list[str]) -> Items:
    items = Items(ids, texts)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(len(items.grams), np.int64)
        for batch in batches:
            for _, data, offsets in ragged.slices(batch, "text"):
                words = ragged.Words(ragged.LOWER[data], offsets)
                _, gram = items.find(words, words.hashes())
                times += np.bincount(gram, minlength=len(times))
        met = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(times[met])], ["gram", "times"])

    counts = documents.select("text").mapInArrow(counted, "gram long, times long")
    counts = counts.groupBy("gram").agg(F.sum("times").alias("times")).toPandas()
    times = np.zeros(len(items.grams), np.int64)
    times[counts["gram"].to_numpy(np.int64)] = counts["times"].to_numpy(np.int64)
    items.use(items.seeds(times))
    return items


def _leaks_found(documents: DataFrame, benchmark: DataFrame) -> Column:
    found = F.array().cast(_FOUND)
    for ids, texts in _parts(benchmark):
        found = F.concat(found, _finder(_seeded(documents, ids, texts)))
    return found


def with_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` with ``leaks`` in place of their own such column: the items found in each text, as item_id, score, first_word, end_word.

    The score is that of the best alignment as a share of the item's highest, ``SCORE`` at
    least; words count from 0, the end is exclusive. Words are compared in lower case (A to Z).
    A NULL or empty text has no leaks. Items that are NULL or without words are never found;
    items of fewer words than a seed are looked for as a whole. Equal items count once; items of
    one number and other texts are each looked for. An empty benchmark finds nothing.

    Runs jobs: the corpus is read once for each part of the benchmark.
    """
    return documents.withColumn("leaks", _leaks_found(documents, benchmark))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word), a row for each item found in a document."""
    return with_leaks(documents.select("doc_id", "text"), benchmark).select("doc_id", F.inline("leaks"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ``documents`` in which no item is found, with the columns they have, whatever their names."""
    return documents.where(F.size(_leaks_found(documents, benchmark)) == 0)
