"""Approximate nearest neighbours by a forest of hash prefixes.

In each tree a vector has a long string of characters: which of some random directions it lies
nearest to, or opposite. The strings of a tree in order are a sorted array, and the vectors that
share a prefix with a query are a stretch of it. A query begins in all trees at the longest prefix
that others share and ascends a character at a time until the ``k``-th nearest it has found is so
near that, by the chance of two vectors at that cosine to share the prefix in some tree, a vector as
near is missed with a chance of ``1 - recall`` at most. The number of entries has no part in it. Above
``SHORTEST`` characters there is the root, which is every vector. A stretch is searched in blocks of
bounded size, with exact cosines. Equal vectors are one entry with their least numbers, as no more
than those can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.scratch import write_table

TREES, LENGTH, DIRECTIONS = 40, 6, 32
# Bits of a character: a direction and its sign.
_BITS = (2 * DIRECTIONS - 1).bit_length()
# A single character in all trees is nearly half of all vectors: below two there is only the root.
SHORTEST = 2
# Share of the nearest that a query finds, expected at the least.
RECALL = 0.9
# Entries, and queries, that one task compares at once.
BLOCK = 4096


def strings(vectors: np.ndarray, tree: int, seed: int = 11) -> np.ndarray:
    """The string of each row in a tree, ``_BITS`` bits for each character."""
    code = np.zeros(len(vectors), np.int64)
    for place in range(LENGTH):
        rng = np.random.default_rng([seed, tree, place, vectors.shape[1]])
        near = vectors @ rng.normal(size=(vectors.shape[1], DIRECTIONS))
        best = np.abs(near).argmax(1)
        code = code << _BITS | best * 2 + (near[np.arange(len(near)), best] > 0)
    return code


def least_cosine(level: int, recall: float = RECALL, seed: int = 5) -> float:
    """The cosine from which on two vectors share ``level`` characters in some tree with a chance of ``recall``.

    Directions are normal, so the chance to share a character depends on the cosine alone; it
    is counted on pairs of drawn rows, and a hundredth is added to the cosine for the counting.
    """
    wanted = (1 - (1 - recall) ** (1 / TREES)) ** (1 / level)
    rng = np.random.default_rng(seed)
    one, other = rng.normal(size=(2, 40_000, DIRECTIONS))
    best = np.abs(one).argmax(1)
    rows = np.arange(len(one))
    low, high = 0.0, 1.0
    while high - low > 1e-3:
        cosine = (low + high) / 2
        near = cosine * one + np.sqrt(1 - cosine * cosine) * other
        same = (np.abs(near).argmax(1) == best) & (near[rows, best] * one[rows, best] > 0)
        low, high = (low, cosine) if same.mean() >= wanted else (cosine, high)
    return min(high + 0.01, 1 - 1e-9)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): numbered vectors that have a direction, each once."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(finite & some).select(F.col("vec_id").cast("long"), v.alias("v")).distinct()


def _stacked(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _keyed(rows: DataFrame, keep: dict[str, str]) -> DataFrame:
    """A row for each tree: size of the vector, tree, string, and the columns to ``keep``."""
    kinds = "".join(f", {name} {kind}" for name, kind in keep.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                for low in range(0, own.num_rows, BLOCK):
                    part = own.slice(low, BLOCK)
                    vectors = _stacked(part.column("v"))
                    for tree in range(TREES):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(vectors), size, np.int32)),
                                pa.array(np.full(len(vectors), tree, np.int32)),
                                pa.array(strings(vectors, tree)),
                                *[part.column(name) for name in keep],
                            ],
                            ["size", "tree", "code", *keep],
                        )

    return rows.mapInArrow(run, f"size int, tree int, code long{kinds}")


_STRETCH = ["size", "tree", "level", "prefix"]


def _at(level: int) -> list:
    """Keys of a stretch."""
    return ["size", "tree", F.lit(level).alias("level"), F.shiftright("code", _BITS * (LENGTH - level)).alias("prefix")]


def _root() -> list:
    """Keys of the one stretch at the root for each size of vectors."""
    return [F.size("v").alias("size"), F.lit(0).alias("tree"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("prefix")]


def _levels(keyed: DataFrame, rows: DataFrame, *rest: str) -> DataFrame:
    """``keyed`` at every level, and ``rows`` at the root."""
    found = [keyed.select(*_at(level), *rest) for level in range(SHORTEST, LENGTH + 1)]
    return reduce(DataFrame.unionByName, found, rows.select(*_root(), *rest))


def _nearest(k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        ids = right.column("ids").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda r: ids[r][0]))
        ids = [ids[r] for r in order]
        entries = _stacked(right.column("v").combine_chunks())[order]
        queries = _stacked(left.column("v").combine_chunks())
        length = np.sqrt((entries * entries).sum(1))
        found: list[tuple] = []
        for number, query in zip(left.column("query_id").to_pylist(), queries, strict=True):
            rough = entries @ query / length
            # A margin for rounding: what could be among the nearest is scored in one fixed way.
            least = np.partition(rough, max(len(rough) - k - 1, 0))[max(len(rough) - k - 1, 0)]
            near = np.flatnonzero(rough >= least - 1e-9 * np.sqrt(query @ query))
            score = (entries[near] * query).sum(1) / (length[near] * np.sqrt((query * query).sum()))
            best = near[np.lexsort((near, -score))[: k + 1]]
            score = np.sort(-score)[: k + 1] * -1
            own = [(-s, i) for s, e in zip(score.tolist(), best.tolist(), strict=True) for i in ids[e] if i != number]
            found += [(number, i, -s) for s, i in sorted(own)[:k]]
        if not found:
            return pa.table(empty)
        columns = list(zip(*found, strict=True))
        return pa.table({n: pa.array(c, empty[n].type) for n, c in zip(empty, columns, strict=True)})

    return run


def _searched(entries: DataFrame, wanted: DataFrame, level: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best in the stretches ``wanted`` of a level.

    ``wanted`` has the keys of the stretch, its number of entries, ``query_id`` and ``v``.
    """
    stretches = wanted.groupBy(*_STRETCH).agg(
        F.ceil(F.first("entries") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")
    )
    stretches = write_table(stretches, "blocks")
    if level:
        candidates = _keyed(entries, {"ids": "array<long>", "v": "array<double>"}).select(*_at(level), "ids", "v")
    else:
        candidates = entries.select(*_root(), "ids", "v")
    # Blocks of a stretch, each against parts of its queries.
    block = F.pmod(F.xxhash64("ids"), F.col("blocks")).cast("int")
    candidates = candidates.join(stretches, _STRETCH).select(
        *_STRETCH, block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "ids", "v"
    )
    part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")
    questions = wanted.join(stretches, _STRETCH).select(
        *_STRETCH, part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query_id", "v"
    )
    keys = [*_STRETCH, "block", "part"]
    found = (
        questions.groupBy(*keys).cogroup(candidates.groupBy(*keys))
        .applyInArrow(_nearest(k), "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, *, every: int = 50, k: int = 5, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose ``vec_id`` is divisible by ``every``.

    Each of the ``k`` nearest is found with a chance of ``recall`` at least over the draw of the
    directions; a query for which no prefix of ``SHORTEST`` characters is enough finds all. Nearness
    is the cosine in double precision, ties go to the smaller ``vec_id``; a query's own
    number is no candidate. Vectors that are NULL, zero, or hold a NULL, NaN or infinite component
    take no part, neither do rows without ``vec_id``; vectors of different length are never
    compared. Equal rows count once; of several vectors with one ``vec_id`` the nearest counts. Fewer than ``k`` rows
    come for a query only if there are fewer candidates in all. An empty table gives an empty result.

    Runs jobs, and keeps the entries and what each level finds in the shared folder.
    """
    usable = write_table(_usable(vectors), "vectors")
    # The least k + 1 numbers of a vector: its own may be one of them.
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = usable.withColumn("turn", first).where(F.col("turn") <= k + 1)
    entries = write_table(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    queries = write_table(usable.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v"), "queries")
    asked = _levels(write_table(_keyed(queries, {"query_id": "long", "v": "array<double>"}), "asked"), queries, "query_id", "v")
    stretches = asked.select(*_STRETCH).distinct()
    counts = _levels(_keyed(entries, {}), entries).groupBy(*_STRETCH).agg(F.count("*").alias("entries"))
    counts = write_table(counts.join(stretches, _STRETCH, "left_semi"), "counts")
    # A query is an entry itself in each tree: with no more than these there is nothing to find yet.
    totals = asked.join(counts, _STRETCH).groupBy("query_id", "level").agg(F.sum("entries").alias("total"))
    begin = totals.where((F.col("level") == 0) | (F.col("total") >= TREES + k)).groupBy("query_id").agg(F.max("level").alias("begin"))
    waiting, settled = write_table(begin, "begin"), []
    for level in [*range(LENGTH, SHORTEST - 1, -1), 0]:
        now = waiting.where(F.col("begin") >= level)
        if now.isEmpty():
            continue
        mine = asked.where(F.col("level") == level).join(now.select("query_id"), "query_id")
        wanted = write_table(mine.join(counts, _STRETCH).select(*_STRETCH, "query_id", "v", "entries"), "wanted")
        found = write_table(_searched(entries, wanted, level, k), "found")
        if level:
            near = (F.col("rank") == k) & (F.col("score") >= least_cosine(level, recall))
            done = found.where(near).select("query_id")
            found = found.join(done, "query_id", "left_semi")
            waiting = write_table(waiting.join(done, "query_id", "left_anti"), "waiting")
        settled.append(found.select("query_id", "rank", "vec_id", "score"))
    if not settled:
        return usable.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, settled)
