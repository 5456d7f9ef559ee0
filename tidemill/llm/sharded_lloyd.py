"""Centroid clustering with vectors sharded by dimension.

Vectors are cut into blocks of columns, one shard each, and rows into chunks. A task on a
shard's blocks knows only that shard's slice of the centroids and gives the exact part of all
squared distances that its columns add. The parts of a chunk are summed by key, and the least
sum names the centroid. The numbers of the centroids go back to the shards, and each shard
computes its own slice of the next centroids from its own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import vectors
from tidemill.scratch import discard, new_path, write_table

# Vectors of a chunk: with the default 10,000 rows a batch holds 40 MB of blocks of 16 columns.
CHUNK_ROWS = 64

_BLOCK = "shard int, chunk long, values binary, ids array<long>"


def _edges(length: int, shards: int) -> list[int]:
    return [length * s // shards for s in range(shards + 1)]


def _blocks(scale: float, edges: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = vectors.matrix(batch.column("embedding"), scale).astype(np.int32)
            ids = batch.column("vec_id").to_pylist()
            found = []
            for low in range(0, len(rows), CHUNK_ROWS):
                part = rows[low : low + CHUNK_ROWS]
                for s, (left, right) in enumerate(zip(edges, edges[1:])):
                    numbers = ids[low : low + CHUNK_ROWS] if s == 0 else None
                    found.append((s, chunk, np.ascontiguousarray(part[:, left:right]).tobytes(), numbers))
                chunk += 1
            if found:
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "values", "ids"])

    return run


def _matrix(values: list[bytes], dtype, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all blocks one after the other, and where each block begins."""
    rows = np.frombuffer(b"".join(values), dtype).reshape(-1, width)
    sizes = [len(x) // (np.dtype(dtype).itemsize * width) for x in values]
    return rows, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _parts(slices: list[np.ndarray]):
    """What the columns of each block add to the squared distances of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = np.asarray(batch.column("shard"))
            for s in np.unique(shards).tolist():
                mine = batch.filter(pa.array(shards == s))
                rows, first = _matrix(mine.column("values").to_pylist(), np.int32, slices[s].shape[1])
                distances = vectors.squared_distances(rows.astype(np.int64), slices[s])
                parts = [distances[a:b].tobytes() for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [mine.column("chunk"), mine.column("shard"), pa.array(parts, pa.binary())], ["chunk", "shard", "part"]
                )

    return run


def _least(centroids: int, shards: int):
    """Sums the parts of each chunk, which arrive one after the other, and takes the least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunk, parts = None, []
        for batch in batches:
            found = []
            for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("part").to_pylist()):
                if chunk != open_chunk:
                    open_chunk, parts = chunk, []
                parts.append(part)
                if len(parts) == shards:
                    total = sum(np.frombuffer(p, np.int64) for p in parts).reshape(-1, centroids)
                    nearest = total.argmin(1)
                    found.append((chunk, nearest.astype(np.int32).tobytes(), total.min(1).tobytes()))
            if found:
                columns = zip(*found)
                kinds = [pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["chunk", "nearest", "distances"]
                )

    return run


def _sums(widths: list[int], centroids: int):
    """Componentwise sums and numbers of each centroid's vectors, per shard, over the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((centroids, width), np.int64) for width in widths]
        counts = [np.zeros(centroids, np.int64) for _ in widths]
        for batch in batches:
            shards = np.asarray(batch.column("shard"))
            for s in np.unique(shards).tolist():
                mine = batch.filter(pa.array(shards == s))
                rows, _ = _matrix(mine.column("values").to_pylist(), np.int32, widths[s])
                nearest = np.frombuffer(b"".join(mine.column("nearest").to_pylist()), np.int32)
                order = np.argsort(nearest, kind="stable")
                heads = np.flatnonzero(np.diff(nearest[order], prepend=-1))
                used = nearest[order][heads]
                totals[s][used] += np.add.reduceat(rows[order].astype(np.int64), heads, axis=0)
                counts[s] += np.bincount(nearest, minlength=centroids)
        for s, width in enumerate(widths):
            used = np.flatnonzero(counts[s])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used) * width, s, np.int32)),
                    pa.array(np.repeat(used, width).astype(np.int32)),
                    pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                    pa.array(totals[s][used].ravel()),
                    pa.array(np.repeat(counts[s][used], width)),
                ],
                ["shard", "centroid", "position", "total", "n"],
            )

    return run


def _rows():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = np.frombuffer(b"".join(batch.column("nearest").to_pylist()), np.int32)
            distances = np.frombuffer(b"".join(batch.column("distances").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids").flatten(), pa.array(nearest), pa.array(distances)], ["vec_id", "cluster", "distance"]
            )

    return run


def _first_centroids(kept: DataFrame, clusters: int, seed: int, scale: float) -> np.ndarray:
    """The vectors of the smallest hashes of ``seed:vec_id``; equal hashes go by components."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = kept.where(F.col("vec_id").isNotNull()).orderBy(draw, "embedding").limit(clusters)
    return vectors.whole(np.array([row.embedding for row in drawn.select("embedding").collect()]), scale)


def _assigned(blocks: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """(chunk, nearest, distances) of each chunk's vectors."""
    parts = blocks.select("chunk", "shard", "values").mapInArrow(_parts(slices), "chunk long, shard int, part binary")
    dealt = parts.repartition("chunk").sortWithinPartitions("chunk", "shard")
    return dealt.mapInArrow(_least(len(slices[0]), len(slices)), "chunk long, nearest binary, distances binary")


def _next_slices(blocks: DataFrame, labels: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """Each shard's slice of the centroids moved to the floored means; unused centroids stay."""
    placed = blocks.select("chunk", "shard", "values").join(labels.select("chunk", "nearest"), "chunk")
    widths = [part.shape[1] for part in slices]
    sums = placed.mapInArrow(_sums(widths, len(slices[0])), "shard int, centroid int, position int, total long, n long")
    whole = sums.groupBy("shard", "centroid", "position").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").cast("decimal(38,0)").alias("n")
    )
    floor = F.expr("cast((total - pmod(total, n)) div n as long)").alias("value")
    moved = [part.copy() for part in slices]
    for shard, centroid, position, value in whole.select("shard", "centroid", "position", floor).collect():
        moved[shard][centroid, position] = value
    return moved


def cluster(
    embeddings: DataFrame, *, clusters: int = 16, rounds: int = 3, scale: float = 64.0, length: int = 64,
    shards: int = 4, seed: int = 1,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of each vector of ``length`` finite components.

    Components are ``floor(scale * x)``. ``distance`` is squared, ``inertia`` its sum over a cluster or
    over all, ``centroid`` the final centroid of the cluster. Ties go to the smaller cluster.

    Vectors that are NULL, of another length, or hold a NULL or non-finite component are left
    out. Every row counts, repeated ones too; rows without ``vec_id`` take part but start no
    centroid. With fewer vectors than ``clusters`` there are as many centroids as rows with an
    id. No vector, or none with an id, gives an empty result. Components that scaled reach
    2 ** 27 are refused. The driver holds the centroids, ``clusters`` times ``length`` numbers.

    Runs jobs, and keeps blocks and assignments in the shared folder.
    """
    spark = embeddings.sparkSession
    edges = _edges(length, shards)
    kept = vectors.finite(embeddings.select(F.col("vec_id").cast("long"), "embedding")).where(F.size("embedding") == length)
    centroids = _first_centroids(kept, clusters, seed, scale)
    if not len(centroids):
        return _named(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], centroids, length)
    path = new_path(spark, "column-blocks")
    kept.mapInArrow(_blocks(scale, edges), _BLOCK).write.partitionBy("shard").parquet(path)
    blocks = spark.read.schema(_BLOCK).parquet(path)
    slices = [np.ascontiguousarray(centroids[:, a:b]) for a, b in zip(edges, edges[1:])]
    for _ in range(rounds):
        step = new_path(spark, "assignments")
        _assigned(blocks, slices).write.parquet(step)
        slices = _next_slices(blocks, spark.read.parquet(step), slices)
        discard(spark, step)
    named = blocks.where("shard = 0").select("chunk", "ids").join(_assigned(blocks, slices), "chunk")
    found = write_table(named.mapInArrow(_rows(), "vec_id long, cluster int, distance long"), "clusters")
    discard(spark, path)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    return _named(found, [(row.cluster, int(row.inertia)) for row in sums], np.hstack(slices), length)


def _named(found: DataFrame, sums: list[tuple[int, int]], centroids: np.ndarray, length: int) -> DataFrame:
    """Rows with what holds for their cluster, from a table of a row per centroid."""
    spark: SparkSession = found.sparkSession
    total: Column = F.lit(sum(inertia for _, inertia in sums)).cast("long")
    described = pa.table(
        {
            "cluster": pa.array([k for k, _ in sums], pa.int32()),
            "cluster_inertia": pa.array([inertia for _, inertia in sums], pa.int64()),
            "centroid": pa.array([centroids[k].tolist() for k, _ in sums], pa.list_(pa.int64())),
        }
    )
    return found.join(spark.createDataFrame(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid"
    )
