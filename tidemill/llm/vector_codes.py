"""Vector codes from codebooks fitted with adaptive distance bounds.

A vector is cut into equal parts, and a part's code is the number of its position's nearest
codebook entry. Between rounds every part keeps its entry, the ``b`` next entries with lower
bounds on their distances in order, and one outer bound for all the others. When entries move,
a bound falls by its entry's movement, the outer bound by the largest movement. The distance to
the own entry is computed exactly; entries whose lower bound is above it need no comparison,
all others are compared in whole numbers, and only if the outer bound is not above it is the whole
codebook. ``b`` follows what a round's parts used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import vectors
from tidemill.operators.groups import join_splittable
from tidemill.scratch import discard, new_path, write_at, write_table

# Parts whose distances to a whole codebook are held together.
_TOGETHER = 2048
# Listed entries are an eighth of the codebook at first, and at least these.
FEWEST = 2
_EIGHTH = 8

_STATE = "vec_id long, label {label}, vector array<int>, code array<int>, near binary, bounds binary, outer binary, used binary"


class Codebooks:
    """Entries of all positions, how far each moved in the last round, and the entries to list."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None, listed: list[int]):
        self.entries, self.moved, self.listed = entries, moved, listed

    def next(self, entries: np.ndarray, listed: list[int]) -> Codebooks:
        change = ((entries - self.entries).astype(np.float64) ** 2).sum(2)
        return Codebooks(entries, _above(np.sqrt(change)), listed)


def _above(values: np.ndarray) -> np.ndarray:
    """Somewhat more than ``values``, so that rounding cannot make an upper bound too low."""
    return values * (1 + 1e-12)


def _below(values: np.ndarray) -> np.ndarray:
    """Somewhat less than ``values``, in single precision: half its last place at least."""
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def _lowered(bounds: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Bounds less the movement, and less than rounding can make of large numbers close together."""
    return bounds - moved - 1e-9 * (np.abs(bounds) + moved)


def assign_all(points: np.ndarray, entries: np.ndarray, listed: int):
    """(code, distance, near, bounds, outer) of each point from its distances to all entries."""
    rows = np.arange(len(points))
    exact = vectors.squared_distances(points, entries)
    code = exact.argmin(1)
    distance = exact[rows, code]
    others = exact.astype(np.float64)
    others[rows, code] = np.inf
    listed = min(listed, len(entries) - 1)
    if listed + 1 < len(entries):
        order = np.argpartition(others, listed, axis=1)
        near, outer = order[:, :listed], np.sqrt(others[rows, order[:, listed]])
    else:
        near, outer = np.argsort(others, axis=1)[:, :listed], np.full(len(points), np.inf)
    bounds = np.take_along_axis(others, near, 1)
    order = np.argsort(bounds, axis=1)
    near, bounds = np.take_along_axis(near, order, 1), np.take_along_axis(bounds, order, 1)
    return code, distance, near, _below(np.sqrt(bounds)), _below(outer)


def assign_bounded(points, entries, moved, listed, code, near, bounds, outer):
    """The same from the state of the round before; and the number of listed bounds each point needed.

    Points whose outer bound does not rule out the entries beyond the list need all: -1.
    """
    rows = np.arange(len(points))
    distance = ((points - entries[code]) ** 2).sum(1)
    upper = _above(np.sqrt(distance.astype(np.float64)))
    bounds = _lowered(bounds, moved[near])
    outer = _lowered(outer, moved.max())
    open_ = outer <= upper
    uncertain = (bounds <= upper[:, None]) & ~open_[:, None]
    at, place = np.nonzero(uncertain)
    compared = near[at, place]
    exact = ((points[at] - entries[compared]) ** 2).sum(1)
    # The nearest of the compared entries and the own one; ties go to the lower number.
    order = np.lexsort((compared, exact, at))
    first = order[np.flatnonzero(np.diff(at[order], prepend=-1))]
    who, entry, best = at[first], compared[first], exact[first]
    better = (best < distance[who]) | ((best == distance[who]) & (entry < code[who]))
    bounds[at, place] = np.sqrt(exact.astype(np.float64))
    who, entry, place_of, best = who[better], entry[better], place[first][better], best[better]
    # The former entry takes the place of the new one in the list.
    near[who, place_of] = code[who]
    bounds[who, place_of] = np.sqrt(distance[who].astype(np.float64))
    code[who], distance[who] = entry, best
    used = np.where(open_, -1, uncertain.sum(1))
    order = np.argsort(bounds, axis=1)
    near, bounds = np.take_along_axis(near, order, 1), np.take_along_axis(bounds, order, 1)
    if listed < near.shape[1]:
        outer = np.minimum(outer, bounds[:, listed])
        near, bounds = near[:, :listed], bounds[:, :listed]
    bounds, outer = _below(bounds), _below(outer)
    for low in range(0, int(open_.sum()), _TOGETHER):
        again = rows[open_][low : low + _TOGETHER]
        found = assign_all(points[again], entries, near.shape[1])
        for state, values in zip((code, distance, near, bounds, outer), found):
            state[again] = values
    return code, distance, near, bounds, outer, used


def _fixed(column: pa.Array, dtype, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(rows, -1)


def _lists(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(rows, -1)


def _as_lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array((np.arange(rows + 1) * width).astype(np.int32)), pa.array(values.astype(np.int32).ravel()))


def _binary(values: np.ndarray) -> pa.Array:
    """A row of ``values`` per binary value."""
    flat = np.ascontiguousarray(values)
    rows, width = len(flat), flat.nbytes // max(len(flat), 1)
    offsets = (np.arange(rows + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def _round(books: Codebooks, before: list[int]):
    """Assigns the parts of each vector, by the state of the round before if there is one."""
    positions, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, _TOGETHER):
                batch = whole.slice(low, _TOGETHER)
                rows = batch.num_rows
                points = _lists(batch.column("vector"), rows).reshape(rows, positions, width)
                states = []
                for p in range(positions):
                    own = points[:, p]
                    if books.moved is None:
                        found = assign_all(own, books.entries[p], books.listed[p])
                        states.append((*found, np.full(rows, -1)))
                        continue
                    skip = sum(before[:p])
                    near = _fixed(batch.column("near"), np.int16, rows)[:, skip : skip + before[p]].astype(np.int64)
                    bounds = _fixed(batch.column("bounds"), np.float32, rows)[:, skip : skip + before[p]].astype(np.float64)
                    outer = _fixed(batch.column("outer"), np.float32, rows)[:, p].astype(np.float64)
                    code = _lists(batch.column("code"), rows)[:, p]
                    states.append(
                        assign_bounded(own, books.entries[p], books.moved[p], books.listed[p], code, near, bounds, outer)
                    )
                code, distance, near, bounds, outer, used = zip(*states)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"), batch.column("label"), batch.column("vector"),
                        _as_lists(np.stack(code, 1)), _binary(np.hstack(near).astype(np.int16)),
                        _binary(np.hstack(bounds).astype(np.float32)), _binary(np.stack(outer, 1).astype(np.float32)),
                        _binary(np.stack(used, 1).astype(np.int16)), pa.array(np.sum(distance, axis=0)),
                    ],
                    ["vec_id", "label", "vector", "code", "near", "bounds", "outer", "used", "error"],
                )

    return run


def _sums(positions: int, entries: int, width: int):
    """Componentwise sums per position and entry over the vectors of a task, and the bounds used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((positions * entries, width), np.int64)
        counts = np.zeros(positions * entries, np.int64)
        used = np.zeros(positions, np.int64)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            points = _lists(batch.column("vector"), rows).reshape(rows * positions, width)
            owner = (_lists(batch.column("code"), rows) + np.arange(positions) * entries).ravel()
            order = np.argsort(owner, kind="stable")
            heads = np.flatnonzero(np.diff(owner[order], prepend=-1))
            totals[owner[order][heads]] += np.add.reduceat(points[order], heads, axis=0)
            counts += np.bincount(owner, minlength=positions * entries)
            used = np.maximum(used, _fixed(batch.column("used"), np.int16, rows).max(0))
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(filled, width)), pa.array(np.tile(np.arange(width), len(filled))),
                pa.array(totals[filled].ravel()), pa.array(np.repeat(counts[filled], width)),
                pa.array(np.repeat(used[filled // entries], width)),
            ],
            ["owner", "component", "total", "n", "used"],
        )

    return run


def _next_codebooks(state: DataFrame, books: Codebooks) -> Codebooks:
    """Entries moved to the floored means of their parts, and lists as long as the last round needed."""
    positions, entries, width = books.entries.shape
    sums = state.select("vector", "code", "used").mapInArrow(
        _sums(positions, entries, width), "owner long, component long, total long, n long, used long"
    )
    whole = sums.groupBy("owner", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").cast("decimal(38,0)").alias("n"), F.max("used").alias("used")
    )
    floor = F.expr("cast((total - pmod(total, n)) div n as long)").alias("value")
    moved, used = books.entries.copy(), [0] * positions
    for owner, component, value, need in whole.select("owner", "component", floor, "used").collect():
        moved[owner // entries, owner % entries, component] = value
        used[owner // entries] = max(used[owner // entries], need)
    if books.moved is None:
        return books.next(moved, books.listed)
    listed = [min(now, max(need, min(FEWEST, now))) for now, need in zip(books.listed, used)]
    return books.next(moved, listed)


def encode(embeddings: DataFrame, *, positions: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0):
    """Codes of each vector, and the final codebooks as (positions, entries, width).

    The table has vec_id, label, codes (array of numbers), error (squared distances summed over the parts)
    and label_error (error summed over equal labels, NULL being one). Components are ``floor(scale * x)``.
    Codebooks start as the parts of the vectors with the ``entries`` smallest ``vec_id``; ties between
    entries go to the lower number, unused entries stay.

    Vectors that are NULL or hold a NULL or non-finite component are left out, and so are those
    whose length is not that of the vector with the smallest ``vec_id``, or not a multiple of
    ``positions``. Repeated rows all count, but a ``vec_id`` starts one entry, from its least vector; rows
    without ``vec_id`` start none. With fewer ids codebooks have as many entries. No vector, or none
    with an id, gives an empty result. Components that scaled reach 2 ** 27 are refused. The driver
    holds the codebooks, ``entries`` times the length of a vector.

    Runs jobs, and keeps each round's bounds in the shared folder until the next is written.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    spark = embeddings.sparkSession
    kind = embeddings.schema["label"].dataType.simpleString()
    kept = vectors.finite(embeddings.select(F.col("vec_id").cast("long"), "label", "embedding"))
    kept = kept.where(F.size("embedding") % positions == 0).where(F.size("embedding") > 0)
    numbered = kept.where(F.col("vec_id").isNotNull())
    least = numbered.orderBy("vec_id", "embedding").select(F.size("embedding").alias("width")).first()
    if least is None:
        empty = spark.createDataFrame([], f"vec_id long, label {kind}, codes array<int>, error long, label_error long")
        return empty, np.empty((positions, 0, 0), np.int64)
    length, width = least.width, least.width // positions
    kept = kept.where(F.size("embedding") == length)
    numbered = numbered.where(F.size("embedding") == length)
    ids = numbered.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()
    first = numbered.where(F.col("vec_id") <= ids[-1].vec_id).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    first = vectors.whole(np.array([row.embedding for row in first.orderBy("vec_id").collect()]), scale)
    start = first.reshape(len(first), positions, width).transpose(1, 0, 2)
    count = start.shape[1]
    books = Codebooks(start, None, [min(max(count // _EIGHTH, FEWEST), count - 1)] * positions)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = vectors.matrix(batch.column("embedding"), scale).astype(np.int32)
            if batch.num_rows:
                columns = [batch.column("vec_id"), batch.column("label"), _as_lists(whole)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector"])

    state = kept.mapInArrow(scaled, f"vec_id long, label {kind}, vector array<int>")
    schema = _STATE.format(label=kind) + ", error long"
    path, before = None, books.listed
    for turn in range(rounds + 1):
        written = new_path(spark, "code-bounds")
        state = write_at(state.mapInArrow(_round(books, before), schema), written)
        if path is not None:
            discard(spark, path)
        path = written
        if turn < rounds:
            before = books.listed
            books = _next_codebooks(state, books)
    found = write_table(state.select("vec_id", "label", F.col("code").alias("codes"), "error"), "codes")
    discard(spark, path)
    sums = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_splittable(found, write_table(sums, "label-errors"), ["label"], null_safe=True), books.entries


def codebooks_sha256(entries: np.ndarray) -> str:
    """Hash of all components by position, entry and place, in decimal with commas between."""
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()
