"""Toxicity by weak supervision.

Words and word beginnings that toxic labelled documents hold far more often than others are
cut by strength into many small lexicons; each lexicon votes toxic where one of its entries occurs, and
patterns of the text vote too. A generative model estimates from the votes alone how often each
voter is right for either class and how far voters repeat each other, and gives each document of
a sample a posterior. A linear classifier over the lexicon entries is trained on those posteriors
and scores all whole texts. What reaches the driver is the bounded lexicon and the sparse rows
of the bounded sample, never texts.
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
from tidemill.scratch import write_table

FOLDS, HELD_OUT = 3, 1
CUT = 0.7
# At most so many labelled documents are used, and so many lexicon entries kept.
SAMPLE_ROWS = 20_000
ENTRIES = 1_000
LEXICONS = 40
# Weaker correlations between voters count as chance.
CORRELATED = 0.4
# Log-odds an entry has at least, with 95 % confidence.
LEAST_ODDS = 2.0
# Share of labels taken to be wrong.
LABEL_ERROR = 0.001
# Beginnings of words, in bytes, that count as entries beside whole words.
BEGINNINGS = (4, 5, 6)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_SALTS = [np.uint64(0x51ED2701 + 0x1F123BB5 * k) for k in range(4)]


def _entries(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of each word and each word beginning of a slice."""
    words = ragged.Words(ragged.LOWER[data], offsets, _LETTER)
    owner, length = words.documents(), words.ends - words.starts
    yield owner, ragged.mix(words.hashes() ^ _SALTS[0])
    for salt, size in zip(_SALTS[1:], BEGINNINGS, strict=True):
        longer = length > size
        starts = words.starts[longer]
        yield owner[longer], ragged.mix(ragged.span_hashes(words.data, starts, starts + size) ^ salt)


def pattern_votes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes of the text patterns: 1 toxic, -1 clean, 0 none; a column for each."""
    size = np.maximum(np.diff(offsets), 1)
    share = lambda chars: ragged.per_document(np.isin(data, list(chars.encode())), offsets) / size
    shouts, asks = share("!"), share("?")
    upper = ragged.per_document((data >= ord("A")) & (data <= ord("Z")), offsets) / size
    stops = share(".")
    return np.stack(
        [
            np.where(shouts > 0.02, 1, 0), np.where(asks > 0.02, 1, 0), np.where(upper > 0.3, 1, 0),
            np.where((stops > 0) & (shouts == 0), -1, 0), np.where((upper > 0) & (upper < 0.05), -1, 0),
        ],
        axis=1,
    ).astype(np.int8)


class Lexicon:
    """Entries by hash; finds which of them the texts of a slice hold."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 18, dtype=bool)
        self.maybe[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def found(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, entry) pairs, each once, in order of documents."""
        pairs = [np.empty(0, np.int64)]
        for owner, hashes in _entries(data, offsets):
            hit = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)])
            if len(hit) and len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, hashes[hit]), len(self.hashes) - 1)
                same = self.hashes[at] == hashes[hit]
                pairs.append(owner[hit[same]] * len(self.hashes) + self.order[at[same]])
        both = np.unique(np.concatenate(pairs))
        size = max(len(self.hashes), 1)
        return both // size, both % size


@dataclass(frozen=True)
class LabelModel:
    """Probabilities of votes (-1, 0, 1 as columns) given each class, and each voter's block."""

    prior: float
    given: np.ndarray
    block: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """A block has the say of its most decisive voter; voters count before those that abstain."""
        voter = np.arange(votes.shape[1])
        ratio = np.log(self.given[1, voter, votes + 1]) - np.log(self.given[0, voter, votes + 1])
        decisive = np.abs(ratio) + 1e3 * (votes != 0)
        total = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for number in np.unique(self.block):
            mine = np.flatnonzero(self.block == number)
            first = decisive[:, mine].argmax(1)
            total += ratio[np.arange(len(votes)), mine[first]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _blocks(correlation: np.ndarray) -> np.ndarray:
    """Number of the block of each voter: those linked by strong correlations, over any steps.

    The last voter, the label, is no copy of the others and stands alone.
    """
    linked = correlation >= CORRELATED
    linked[-1] = linked[:, -1] = False
    block = np.arange(len(linked))
    while True:
        least = np.where(linked, block[None, :], len(block)).min(1)
        least = np.minimum(least, block)
        if (least == block).all():
            return block
        block = least


def fit_label_model(votes: np.ndarray, labels: np.ndarray, *, rounds: int = 10) -> LabelModel:
    """Expectation and maximisation over all rows, from beliefs that follow the labels loosely.

    Voters that go together more than the class explains (their correlation within the
    classes) form a block and are not counted as independent.
    """
    n = len(votes)
    belief = np.where(labels > 0, 0.95, 0.05).astype(np.float64)
    kinds = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(np.float64)
    model = None
    for _ in range(rounds):
        prior = float(np.clip((belief.sum() + 1) / (n + 2), 1e-4, 1 - 1e-4))
        given = np.stack([np.einsum("n,nvk->vk", b, kinds) + 0.5 for b in (1 - belief, belief)])
        given /= given.sum(2, keepdims=True)
        given[:, -1] = np.array([[1 - LABEL_ERROR, 0, LABEL_ERROR], [LABEL_ERROR, 0, 1 - LABEL_ERROR]]) + 1e-9
        rest, spread = 0.0, 0.0
        for c, b in enumerate((1 - belief, belief)):
            centred = votes - (given[c] @ np.array([-1.0, 0.0, 1.0]))
            rest = rest + (centred * b[:, None]).T @ centred
            spread = spread + (centred**2 * b[:, None]).sum(0)
        scale = np.sqrt(np.maximum(spread, 1e-9))
        model = LabelModel(prior, given, _blocks(np.abs(rest / scale[:, None] / scale[None, :])))
        belief = model.posterior(votes)
    return model


@dataclass(frozen=True)
class Classifier:
    """Linear over lexicon entries; the log-odds of a text are ``bias`` and its entries' sum."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, lexicon: Lexicon, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        owner, entry = lexicon.found(data, offsets)
        total = self.bias + np.bincount(owner, self.weights[entry], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_linear(
    rows: np.ndarray, entries: np.ndarray, target: np.ndarray, size: int, *, rounds: int = 400, rate: float = 0.1, decay: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets over sparse 0/1 features, by steps of adapted size."""
    n = len(target)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    weights = np.append(np.zeros(size), np.log(share / (1 - share)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, rounds + 1):
        total = weights[-1] + np.bincount(rows, weights[entries], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - target
        slope = np.append(np.bincount(entries, error[rows], minlength=size) / n + decay * weights[:-1], error.mean())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= rate * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return weights[:-1], float(weights[-1])


def train(documents: DataFrame, labels: DataFrame, *, label: str = "toxic", rows: int = SAMPLE_ROWS, entries: int = ENTRIES) -> Classifier:
    """Lexicons, label model and classifier from at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_sample(labels, label, FOLDS, HELD_OUT, rows)
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")

    def kin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text"):
                words = ragged.Words(ragged.LOWER[data], offsets)
                runs, hashes = ragged.ngram_starts(words.first, 4), words.hashes()
                least = np.full(part.num_rows, np.iinfo(np.uint64).max)
                if len(runs):
                    np.minimum.at(least, words.documents()[runs], ragged.ngram_hashes(hashes, 4)[runs])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(least.astype(np.int64))], ["text", "label", "kin"]
                )

    # Copies of one text would make all its words look toxic, or clean: one of each stays.
    chosen = chosen.mapInArrow(kin, "text string, label int, kin long").dropDuplicates(["kin", "label"])
    chosen = write_table(chosen, "toxicity-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text"):
                label = part.column("label").to_numpy().astype(np.int64)
                hashes, toxic = [], []
                for owner, found in _entries(data, offsets):
                    order = np.lexsort((found, owner))
                    owner, found = owner[order], found[order]
                    new = np.append(True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1]))[: len(owner)]
                    hashes.append(found[new])
                    toxic.append(label[owner[new]])
                hashes, toxic = np.concatenate(hashes), np.concatenate(toxic)
                order = np.argsort(hashes, kind="stable")
                kinds, times = ragged.sorted_runs(hashes[order])
                if len(kinds):
                    bad = np.add.reduceat(toxic[order], np.cumsum(times) - times)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kinds.astype(np.int64)), pa.array(bad), pa.array(times - bad)], ["entry", "toxic", "clean"]
                    )

    totals = chosen.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    bad, good = float(totals["toxic"]), float(totals["n"] - totals["toxic"])
    counts = chosen.mapInArrow(counted, "entry long, toxic long, clean long").groupBy("entry")
    counts = counts.agg((F.sum("toxic") + 0.5).alias("t"), (F.sum("clean") + 0.5).alias("c"))
    odds = F.log(F.col("t") / (bad + 1 - F.col("t"))) - F.log(F.col("c") / (good + 1 - F.col("c")))
    error = F.sqrt(1 / F.col("t") + 1 / F.col("c"))
    # The lower end of the odds: what is toxic by chance in few documents comes late or not at all.
    least = (odds - 1.64 * error).alias("least")
    lexicon = (
        counts.where("t >= 3").select("entry", least)
        .where(F.col("least") > LEAST_ODDS).orderBy(F.desc("least"), "entry").limit(entries).toPandas()
    )
    hashes = lexicon["entry"].to_numpy(np.int64).astype(np.uint64)
    finder = Lexicon(hashes)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text"):
                owner, entry = finder.found(data, offsets)
                first = np.searchsorted(owner, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(entry)),
                        pa.array(pattern_votes(data, offsets).astype(np.int32).tolist(), pa.list_(pa.int32())),
                    ],
                    ["label", "entries", "patterns"],
                )

    found = chosen.mapInArrow(marked, "label int, entries array<long>, patterns array<int>").toPandas()
    label_of = found["label"].to_numpy(np.int64)
    held = [np.asarray(e, np.int64) for e in found["entries"]]
    row = np.repeat(np.arange(len(held)), [len(e) for e in held])
    entry = np.concatenate([*held, np.empty(0, np.int64)])
    if len(found) == 0 or label_of.min() == label_of.max():
        share = (label_of.sum() + 0.5) / (len(found) + 1)
        return Classifier(hashes, np.zeros(len(hashes)), float(np.log(share / (1 - share))))
    votes = np.zeros((len(found), LEXICONS + 1), np.int64)
    # Entries come by strength, so the lexicons differ in how far they can be trusted.
    votes[row, entry * LEXICONS // max(len(hashes), 1)] = 1
    votes[:, LEXICONS] = np.where(np.bincount(row, minlength=len(found)) == 0, -1, 0)
    # The label is one more voter, the last; its accuracy is given and anchors the others'.
    patterns = np.array(found["patterns"].tolist(), np.int64)
    votes = np.concatenate((votes, patterns, 2 * label_of[:, None] - 1), 1)
    target = fit_label_model(votes, label_of).posterior(votes)
    order = np.lexsort((entry, row))
    weights, bias = fit_linear(row[order], entry[order], target, len(hashes))
    return Classifier(hashes, weights, bias)


def score_toxicity(documents: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted`` in place of their own such columns.

    A NULL text is scored as an empty one. A NULL ``doc_id`` is not held out. Each of several
    equal rows is scored. An empty table gives an empty result; without labels all scores are
    0.5, with labels of one class the smoothed share. Runs jobs, and keeps the sample in the
    shared folder.
    """
    model = train(documents, labels, rows=rows)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(model.hashes)
        for column in texts:
            batch = pa.record_batch([column], ["text"])
            scores = [model.score(lexicon, data, offsets) for _, data, offsets in ragged.slices(batch, "text")]
            yield pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())

    return documents.withColumns(
        {"held_out": held_out("doc_id", FOLDS, HELD_OUT), "score": score("text")}
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
