"""Near-duplicate fingerprints by anchor points.

A fingerprint has 64 bits, one for each bit that more than half of a text's shingle hashes set.
Two fingerprints that differ in at most ``threshold`` bits differ in at most half as many in their
upper or in their lower 32 bits. Each half has anchors: the words of a Hamming code on 31 bits,
with the last bit free, so that every half is within 1 bit of an anchor (the covering radius).
Halves at distance ``d`` have a point midway, within ``(d + 1) // 2`` of both, and that point has an
anchor within the covering radius. So both reach this anchor if each goes to every anchor within
the covering radius and half the threshold, which is less than the covering radius and
threshold that one of them would need if the other went only to its own anchor.

Fingerprints are compared per anchor, and a forest of the links is all that leaves a task. An
anchor with many fingerprints is split by the anchors of the other half, where fingerprints
may be the whole threshold apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import ragged
from tidemill.llm.components import components
from tidemill.operators.groups import join_splittable
from tidemill.scratch import discard, new_path, write_at, write_table

# Seed of the hash; length of the code.
SEED = 42
_CODE_BITS = 31
_COVERING_RADIUS = 1
# Fingerprints of an anchor compared in one task; beyond it the anchor is split.
ANCHOR_ROWS = 32_768
# Shingles whose hashes are unpacked together.
_UNPACKED = 1 << 16


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, repeats included, and where each text's begin.

    A shingle is ``size`` words in lower case (A to Z) with a blank between; a text with fewer words
    has one, all its words; a text without words has none.
    """
    words = ragged.Words(ragged.LOWER[data], offsets)
    spans = words.ends - words.starts
    # The words one after the other with a blank behind each; shingles are stretches of that.
    ends = np.cumsum(spans + 1) - 1
    starts = ends - spans
    inside = np.arange(int(spans.sum())) - np.repeat(np.cumsum(spans) - spans, spans)
    joined = np.full(int((spans + 1).sum()), 0x20, np.uint8)
    joined[np.repeat(starts, spans) + inside] = words.data[np.repeat(words.starts, spans) + inside]
    text = joined.tobytes()
    first = words.first
    counts = np.diff(first)
    amounts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    found = np.concatenate(([0], np.cumsum(amounts)))
    owner = np.repeat(np.arange(len(counts)), amounts)
    head = np.arange(found[-1]) - found[owner] + first[owner]
    tail = np.minimum(head + size, first[owner + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(starts[head].tolist(), ends[tail].tolist())]
    return np.array(hashes, np.uint64), found


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the bits set in over half of its hashes; 0 for a text without any."""
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    set_ = np.zeros((len(counts), 64), np.int64)
    for low in range(0, len(hashes), _UNPACKED):
        part, whose = hashes[low : low + _UNPACKED], owner[low : low + _UNPACKED]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.diff(whose, prepend=-1))
        set_[whose[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    majority = (2 * set_ > counts[:, None]).astype(np.uint64)
    return (majority << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def _fingerprinted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text"):
                found = fingerprints(*shingle_hashes(data, offsets, size))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"]
                )

    return run


@cache
def _errors(radius: int) -> list[np.ndarray]:
    """For each syndrome of the code, what to flip in 32 bits to get to each anchor within ``radius``.

    The syndrome of a word is the exclusive or of the numbers (1 to 31) of its set bits; words
    with syndrome 0 are the code. Bit 31 counts for none, so any value of it is allowed.
    """
    found: list[list[int]] = [[] for _ in range(_CODE_BITS + 1)]
    for weight in range(radius + 1):
        for flipped in combinations(range(32), weight):
            syndrome = 0
            for bit in flipped:
                syndrome ^= (bit + 1) & _CODE_BITS
            found[syndrome].append(sum(1 << bit for bit in flipped))
    return [np.array(masks, np.uint64) for masks in found]


def _syndromes(halves: np.ndarray) -> np.ndarray:
    total = np.zeros(len(halves), np.int64)
    for bit in range(_CODE_BITS):
        total ^= np.where((halves >> np.uint64(bit)) & np.uint64(1), bit + 1, 0)
    return total


def anchors(halves: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, anchor) of every anchor within ``radius`` of each 32-bit number."""
    masks = _errors(radius)
    syndromes = _syndromes(halves)
    positions, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for syndrome in np.unique(syndromes).tolist():
        at = np.flatnonzero(syndromes == syndrome)
        found.append((halves[at][:, None] ^ masks[syndrome]).ravel())
        positions.append(np.repeat(at, len(masks[syndrome])))
    return np.concatenate(positions), np.concatenate(found)


_AT = ["half", "anchor", "further"]
_PLACED = "half int, anchor long, further long, fingerprint long"
# Rows handed on at a time.
_OUT = 1 << 17


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values >> np.uint64(32), values & np.uint64(0xFFFFFFFF)


def _placed(radius: int):
    """Fingerprints at every anchor of both halves."""
    step = max(_OUT // (2 * max(map(len, _errors(radius)))), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("fingerprint")).view(np.uint64)
            for low in range(0, len(values), step):
                part = values[low : low + step]
                for half, bits in enumerate(_halves(part)):
                    at, anchor = anchors(bits, radius)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), half, np.int32)), pa.array(anchor.astype(np.int64)),
                            pa.array(np.full(len(at), -1, np.int64)), pa.array(part[at].view(np.int64)),
                        ],
                        [*_AT, "fingerprint"],
                    )

    return run


def _split(radius: int):
    """Fingerprints of one half's anchor at every anchor of the other half too."""
    step = max(_OUT // max(map(len, _errors(radius))), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                upper, lower = _halves(np.asarray(part.column("fingerprint")).view(np.uint64))
                at, further = anchors(np.where(np.asarray(part.column("half")) == 0, lower, upper), radius)
                kept = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("half"), kept.column("anchor"), pa.array(further.astype(np.int64)), kept.column("fingerprint")],
                    [*_AT, "fingerprint"],
                )

    return run


def linked(values: np.ndarray, threshold: int) -> np.ndarray:
    """For each of some different fingerprints the position of one of its component's, the same for all of them.

    Fingerprints are compared with one at a time, outside the largest component found so far:
    of two in different components one at least is outside, so every pair that could join
    components is compared, and a family that the first comparison joins costs only that.
    """
    label = np.arange(len(values))
    done = np.zeros(len(values), bool)
    while True:
        sizes = np.bincount(label, minlength=len(values))
        waiting = np.flatnonzero((label != sizes.argmax()) & ~done)
        if not len(waiting):
            return label
        for at in waiting.tolist():
            done[at] = True
            joined = np.unique(label[np.bitwise_count(values ^ values[at]) <= threshold])
            if len(joined) > 1:
                new = np.arange(len(values))
                new[joined] = joined[0]
                label = new[label]
                break


def _compared(threshold: int):
    """Pairs (a, b) that join the components of each anchor; rows come sorted by anchor."""

    def pairs(rows: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.append(heads[1:], len(rows))
        owner = np.repeat(np.arange(len(heads)), ends - heads)
        star = np.bitwise_count(rows ^ rows[heads][owner]) <= threshold
        star[heads] = False
        left, right = [rows[heads][owner[star]]], [rows[star]]
        joined = np.add.reduceat(star, heads, dtype=np.int64) if len(heads) else ends
        for group in np.flatnonzero((joined < ends - heads - 1) & (ends - heads > 2)).tolist():
            members = rows[heads[group] : ends[group]]
            label = linked(members, threshold)
            more = label != np.arange(len(members))
            left.append(members[label[more]])
            right.append(members[more])
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
            table = np.concatenate(parts)
            changed = (table[1:, :3] != table[:-1, :3]).any(1)
            a, b = pairs(np.ascontiguousarray(table[:, 3]).view(np.uint64), np.flatnonzero(np.append(True, changed)))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rows = np.column_stack([np.asarray(batch.column(name)).astype(np.int64) for name in [*_AT, "fingerprint"]])
            if not len(rows):
                continue
            # The last anchor of a batch may go on in the next.
            cut = len(rows) - int((rows[:, :3] == rows[-1, :3]).all(1).sum())
            if cut:
                yield flush([*held, rows[:cut]])
                held = []
            elif held and (held[-1][-1, :3] != rows[-1, :3]).any():
                yield flush(held)
                held = []
            held.append(rows[cut:])
        if held:
            yield flush(held)

    return run


def _shared(placed: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows of anchors with 2 to ``limit`` fingerprints, and of those with more."""
    counts = placed.groupBy(*_AT).agg(F.count("*").alias("members")).where("members > 1")
    rows = join_splittable(placed, counts, _AT)
    return rows.where(F.col("members") <= limit).drop("members"), rows.where(F.col("members") > limit).drop("members")


def links(prints: DataFrame, *, threshold: int = 4, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(a, b): pairs of the different ``fingerprint`` values whose components are those of all links.

    Two that differ in at most ``threshold`` bits are joined by these pairs, directly or through
    others, and no pair joins what links do not. Runs jobs, and keeps anchors in the shared folder.
    """
    spark = prints.sparkSession
    radius = _COVERING_RADIUS + (threshold // 2 + 1) // 2
    wider = _COVERING_RADIUS + (threshold + 1) // 2
    paths = [new_path(spark, name) for name in ("anchors", "crowded-anchors")]
    places = write_at(prints.select("fingerprint").mapInArrow(_placed(radius), _PLACED), paths[0])
    few, many = _shared(places, anchor_rows)
    split = write_at(many, paths[1]).mapInArrow(_split(wider), _PLACED)
    found = few.unionByName(split).repartition(*_AT).sortWithinPartitions(*_AT)
    written = write_table(found.mapInArrow(_compared(threshold), "a long, b long"), "anchor-links")
    for path in paths:
        discard(spark, path)
    return written


def near_fingerprints(
    documents: DataFrame, *, size: int = 4, threshold: int = 4, anchor_rows: int = ANCHOR_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) of each row of ``documents``.

    Two documents are linked if their fingerprints differ in at most ``threshold`` bits; equal ones
    are one class from the start. ``component_id`` is the least ``doc_id`` a document can reach, ``kept``
    marks that one. A NULL or empty text, and one without words, has fingerprint 0 and is linked
    like any other. Rows that share a ``doc_id`` count as one document with the links of all of
    them. A row without ``doc_id`` links others but is nobody's component; if it reaches no id, it has
    no component and is kept. An empty table gives an empty result.

    Runs jobs, and keeps fingerprints, anchors and links in the shared folder.
    """
    plain = documents.select(F.col("doc_id").cast("long"), "text")
    prints = write_table(plain.mapInArrow(_fingerprinted(size), "doc_id long, fingerprint long"), "fingerprints")
    classes = write_table(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    several = prints.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    several = several.agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")).where("a < b")
    same_id = join_splittable(prints, several.select("doc_id", "a"), ["doc_id"]).select("a", F.col("fingerprint").alias("b"))
    groups = components(links(classes, threshold=threshold, anchor_rows=anchor_rows).unionByName(same_id))
    known = classes.join(groups, classes["fingerprint"] == groups["id"], "left")
    known = known.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    known = write_table(known, "fingerprint-groups")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = write_table(join_splittable(known, least, ["component"]).select("fingerprint", "component_id"), "named-groups")
    found = join_splittable(prints, named, ["fingerprint"])
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.col("component_id").isNull())
    return found.select("doc_id", "fingerprint", "component_id", kept.alias("kept"))
