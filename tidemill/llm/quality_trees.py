"""Quality classifier: histogram gradient-boosted trees over document statistics.

Tasks turn whole texts into a few dozen statistics with array operations. Trees are grown on
the statistics of a bounded labelled sample, flattened into arrays (feature, threshold, value
by heap position), and shipped to the tasks, where all rows of a slice walk all trees at
once. Labels and documents outside the sample are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import ragged
from tidemill.llm.held_out import held_out, labelled_sample

FOLDS, HELD_OUT = 4, 2
CUT = 0.7
# At most so many labelled documents are used to grow the trees.
SAMPLE_ROWS = 20_000

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "punctuation", "other_bytes", "blank",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "punctuation_tail", "punctuation_words",
    "upper_words", "log_lines", "words_per_line", "distinct_lines", "stops_per_word", "longest_word", "repeated_after_two",
)

_UPPER, _DIGIT, _PUNCTUATION, _OTHER, _BLANK, _STOP = range(6)
_CLASSES = np.zeros((6, 256), dtype=bool)
_CLASSES[_UPPER, ord("A") : ord("Z") + 1] = True
_CLASSES[_DIGIT, ord("0") : ord("9") + 1] = True
_CLASSES[_PUNCTUATION, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_CLASSES[_OTHER, 128:] = True
_CLASSES[_BLANK] = ~ragged.WORD_BYTE
_CLASSES[_STOP, [ord(c) for c in ".!?"]] = True
_NOT_BREAK = np.ones(256, dtype=bool)
_NOT_BREAK[ord("\n")] = False


def _distinct(document: np.ndarray, hashes: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: how many different hashes, and how often the most frequent occurs."""
    keys = np.sort((document.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    values, times = ragged.sorted_runs(keys)
    owner = (values >> np.uint64(40)).astype(np.int64)
    distinct = np.bincount(owner, minlength=documents)
    most = np.zeros(documents, np.int64)
    np.maximum.at(most, owner, times)
    return distinct, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Matrix of ``STATISTICS`` for the texts of a slice; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    share = np.stack([ragged.per_document(_CLASSES[k][data], offsets) for k in range(6)], 1)
    words = ragged.Words(data, offsets)
    count, owner = words.counts(), words.documents()
    hashes = words.hashes()
    length = words.ends - words.starts
    distinct, most = _distinct(owner, hashes, n)
    same_owner = owner[1:] == owner[:-1]
    pairs = ragged.ngram_hashes(hashes, 2)[same_owner]
    distinct_pairs, _ = _distinct(owner[:-1][same_owner], pairs, n)
    repeated = np.bincount(owner[1:][same_owner & (hashes[1:] == hashes[:-1])], minlength=n)
    two_apart = (owner[2:] == owner[:-2]) & (hashes[2:] == hashes[:-2])
    after_two = np.bincount(owner[2:][two_apart], minlength=n)
    last = words.ends - 1
    punctuation = _CLASSES[_PUNCTUATION]
    tail = punctuation[data[last]] & punctuation[data[np.maximum(last - 1, 0)]] & (length > 1)
    bare = ragged.per_document(punctuation[data[words.starts]] & punctuation[data[last]] & (length <= 2), words.first)
    tails = ragged.per_document(tail, words.first)
    upper = np.concatenate(([0], np.cumsum(_CLASSES[_UPPER][data])))
    upper_words = ragged.per_document(upper[words.ends] - upper[words.starts] >= np.maximum(length * 0.5, 2), words.first)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, length)
    lines = ragged.Words(data, offsets, _NOT_BREAK)
    distinct_lines, _ = _distinct(lines.documents(), lines.hashes(), n)
    n_lines = lines.counts()
    over_bytes, over_words, over_lines = np.maximum(size, 1), np.maximum(count, 1), np.maximum(n_lines, 1)
    return np.stack(
        [
            np.log1p(size), np.log1p(count), size / over_words,
            share[:, _UPPER] / over_bytes, share[:, _DIGIT] / over_bytes, share[:, _PUNCTUATION] / over_bytes,
            share[:, _OTHER] / over_bytes, share[:, _BLANK] / over_bytes,
            distinct / over_words, most / over_words, repeated / over_words, distinct_pairs / over_words,
            tails / over_words, bare / over_words, upper_words / over_words,
            np.log1p(n_lines), count / over_lines, distinct_lines / over_lines,
            share[:, _STOP] / over_words, np.log1p(longest), after_two / over_words,
        ],
        axis=1,
    ).astype(np.float64)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees in heap order: child ``2 i + 1`` is left, ``2 i + 2`` right."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.start)
        if len(self.feature):
            depth = (self.feature.shape[1] + 1).bit_length() - 1
            tree = np.arange(len(self.feature))[None, :]
            row = np.arange(len(x))[:, None]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
            total = total + self.value[tree, at - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(
    x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
    shrink: float = 1.0, least: float = 3.0,
) -> Trees:
    """Boosted trees for the log-odds of ``y``; each split is chosen from histograms of bins.

    Without rows the score is 0.5 everywhere, with rows of one label the smoothed share.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    if len(y) == 0 or y.min() == y.max():
        empty = np.zeros((0, inner))
        return Trees(start, empty.astype(np.int64), empty, np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    features, thresholds, values = [], [], []
    total = np.full(len(y), start)
    width = bins + 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            base, nodes = (1 << level) - 1, 1 << level
            local = at - base
            best = np.zeros(nodes)
            chosen = np.zeros((nodes, 2), np.int64)
            for f in range(x.shape[1]):
                cell = local * width + binned[:, f]
                g = np.bincount(cell, gradient, nodes * width).reshape(nodes, width).cumsum(1)
                h = np.bincount(cell, weight, nodes * width).reshape(nodes, width).cumsum(1)
                left_g, left_h = g[:, : len(edges[f])], h[:, : len(edges[f])]
                if not left_g.shape[1]:
                    continue
                all_g, all_h = g[:, -1:], h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + shrink) + right_g**2 / (right_h + shrink) - all_g**2 / (all_h + shrink)
                gain[(left_h < least) | (right_h < least)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(nodes), top] > best + 1e-9
                best[better] = gain[np.arange(nodes), top][better]
                chosen[better] = np.stack([np.full(nodes, f), top], 1)[better]
            split = best > 0
            feature[base : base + nodes] = chosen[:, 0]
            threshold[base : base + nodes] = [edges[f][b] if s else np.inf for (f, b), s in zip(chosen, split, strict=True)]
            cut = np.where(split, chosen[:, 1], width)
            at = 2 * at + 1 + (binned[np.arange(len(y)), chosen[local, 0]] > cut[local])
        leaf = at - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, weight, inner + 1)
        value = rate * g / (h + shrink)
        total = total + value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(start, np.array(features), np.array(thresholds), np.array(values))


def train(documents: DataFrame, labels: DataFrame, *, label: str = "quality", rows: int = SAMPLE_ROWS) -> Trees:
    """Trees grown on at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_sample(labels, label, FOLDS, HELD_OUT, rows)
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text"):
                x = pa.array(list(statistics(data, offsets)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([x, part.column("label")], ["x", "label"])

    found = chosen.mapInArrow(measured, "x array<double>, label int").toPandas()
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), len(STATISTICS))
    y = found["label"].to_numpy(np.float64)
    order = np.lexsort([y, *x.T])
    return grow(x[order], y[order])


def score_quality(documents: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted`` in place of their own such columns.

    A NULL text is scored as an empty one. A NULL ``doc_id`` is not held out. Each of several
    equal rows is scored. An empty table gives an empty result; without labels all scores are 0.5.
    """
    trees = train(documents, labels, rows=rows)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            batch = pa.record_batch([column], ["text"])
            scores = [trees.score(statistics(data, offsets)) for _, data, offsets in ragged.slices(batch, "text")]
            yield pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())

    return documents.withColumns(
        {"held_out": held_out("doc_id", FOLDS, HELD_OUT), "score": score("text")}
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
