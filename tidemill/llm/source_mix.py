"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's words are cut into blocks, and its target becomes a quota of blocks: whole passes
over the source, then part of one more. From the root of a binary tree over the output shards,
every node gives its left half a draw without replacement from the quotas it has and its right
half the rest, so each shard's counts are those of a random deal, add up exactly, and follow
from the seed alone. Sources may be many: the tree on the driver deals groups of sources, and a
task for each group deals its shards' counts among the group's sources, which is the same draw in
two steps. In a pass blocks are numbered by a keyed permutation of their positions:
the blocks of different shards are disjoint, and no sort of blocks is needed. A shard's blocks
are then put in order of a hash, inside the shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import ragged
from tidemill.operators.groups import join_splittable
from tidemill.operators.ranks import dense_ranks
from tidemill.scratch import write_table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 32
SHARDS = 256
# Counts of groups of sources in shards that the driver holds at most.
PLAN_COUNTS = 1_000_000
# Documents whose places are added up in one task.
RUN_ROWS = 20_000
# Bytes of rows handed to Python together; each row carries its source's part of the plan.
BATCH_BYTES = 1 << 20


def word_count(text: str) -> Column:
    """Number of words of a text; NULL has none."""

    @F.arrow_udf("long")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            batch = pa.record_batch([column], ["text"])
            counts = [ragged.Words(data, offsets).counts() for _, data, offsets in ragged.slices(batch, "text")]
            yield pa.array(np.concatenate(counts) if counts else np.empty(0, np.int64), pa.int64())

    return count(text)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to (number, size): ``share`` of all words by weight, at most ``most`` times a
    source's own; the excess is shared by weight among the others until none is above.

    ``number`` counts the sources from 0, and takes the weights in turn. A job for each time that
    sources turn out to be above; the driver holds a row for each weight.
    """
    weight = F.element_at(F.lit(list(weights)), (F.col("number") % len(weights) + 1).cast("int"))
    limit = F.lit(most) * F.col("size")
    full, known = F.lit(False), -1
    whole = sources.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    while True:
        rows = sources.groupBy(weight.alias("weight"), full.alias("full")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        rows = rows.collect()
        above = sum(r["n"] for r in rows if r["full"])
        if above == known:
            return sources.withColumn("target", F.when(full, limit).otherwise(dealt))
        known = above
        left = share * whole - most * sum(r["size"] for r in rows if r["full"])
        spread = sum(r["weight"] * r["n"] for r in rows if not r["full"])
        dealt = F.lit(left) * weight / F.lit(spread or 1.0)
        full = full | (dealt > limit) if spread else full


def _draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Hypergeometric draw; for very large counts the rounded normal one, inside the same limits."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample)) if good + bad else 0
    total = good + bad
    mean = sample * good / total
    spread = (mean * (bad / total) * ((total - sample) / max(total - 1, 1))) ** 0.5
    return int(min(max(round(rng.normal(mean, spread)), sample - bad, 0), good, sample))


def _split(rng: np.random.Generator, quotas: np.ndarray, sample: int) -> np.ndarray:
    """How many blocks of each quota a draw of ``sample`` without replacement takes."""
    rest = int(quotas.sum())
    if rest < 1_000_000_000:
        return rng.multivariate_hypergeometric(quotas, sample, method="marginals")
    taken = np.zeros_like(quotas)
    for k in np.flatnonzero(quotas).tolist():
        rest -= int(quotas[k])
        taken[k] = _draw(rng, int(quotas[k]), rest, sample)
        sample -= int(taken[k])
    return taken


def deal(quotas: list[int], shards: int, seed: list[int], totals: np.ndarray | None = None) -> np.ndarray:
    """Blocks of each source (columns) in each shard (rows); a row adds up to its ``totals``, or else all are as equal as can be."""
    own = np.array(quotas, np.int64)
    if totals is None:
        whole = int(own.sum())
        totals = np.diff([whole * k // shards for k in range(shards + 1)])
    until = np.concatenate(([0], np.cumsum(totals)))
    counts = np.zeros((shards, len(own)), np.int64)
    nodes = [(0, shards, own)]
    while nodes:
        low, high, own = nodes.pop()
        if high - low == 1:
            counts[low] = own
            continue
        middle = (low + high) // 2
        left = _split(np.random.default_rng([*seed, low, high]), own, int(until[middle] - until[low]))
        nodes += [(low, middle, left), (middle, high, own - left)]
    return counts


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to ``size - 1`` at ``index``: four mixing rounds on two halves of
    the bits, repeated for values outside until they are inside."""
    half = max((max(size - 1, 1).bit_length() + 1) // 2, 1)
    mask = np.uint64((1 << half) - 1)
    value = index.astype(np.uint64)
    open_ = np.arange(len(value))
    while len(open_):
        left, right = value[open_] >> np.uint64(half), value[open_] & mask
        for turn in range(4):
            salt = np.uint64((key * 4 + turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (ragged.mix(right ^ salt) & mask)
        value[open_] = left << np.uint64(half) | right
        open_ = open_[value[open_] >= size]
    return value.astype(np.int64)


def _slots(index: np.ndarray, size: int, quota: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of a source's blocks at ``index`` the mix takes (places in ``index``), and their slots in its quota."""
    places, slots = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for turn in range(-(-quota // size) if size else 0):
        slot = turn * size + permuted(index, size, key * 31 + turn)
        taken = np.flatnonzero(slot < quota)
        places.append(taken)
        slots.append(slot[taken])
    return np.concatenate(places), np.concatenate(slots)


def _sized(documents: DataFrame, block_words: int) -> DataFrame:
    sized = documents.select(
        F.col("doc_id").cast("long"), "source", F.xxhash64("text").alias("mark"), word_count("text").alias("size")
    )
    return sized.withColumn("blocks", F.ceil(F.col("size") / block_words).cast("long"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds ``number``, from 0 by code point, NULL last."""
    ranks = dense_ranks(sources.where("source IS NOT NULL"), [], "source").select(
        F.col("source").alias("named"), (F.col("rank_ascending") - 1).alias("number")
    )
    ranks = write_table(ranks, "source-numbers")
    last = F.lit(ranks.count())
    joined = sources.join(ranks, F.col("source") == F.col("named"), "left")
    return joined.select("source", F.coalesce("number", last).cast("long").alias("number"), "size", "blocks")


_PLAN = "source string, number long, source_size long, source_blocks long, target double, quota long, starts binary"


def plan(
    sized: DataFrame, *, weights=WEIGHTS, share=SHARE, most=MOST, shards: int = SHARDS, seed: int = 7, groups: int | None = None
) -> DataFrame:
    """A row per source of (source, size, blocks): its number, words, blocks, target, quota of blocks, and
    where each shard's slots begin (``starts``, 64-bit numbers, one more than there are shards).

    Sources are dealt to ``groups`` by their numbers, as many as ``PLAN_COUNTS`` allows unless given. The driver
    deals the groups' quotas, a task for each group those of its sources.
    """
    groups = groups or max(1, PLAN_COUNTS // shards)
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.sum("blocks").alias("blocks"))
    aimed = targets(write_table(_numbered(write_table(rows, "sources")), "numbered-sources"), weights, share, most)
    wanted = F.bround(F.try_divide(F.col("target"), F.col("size")) * F.col("blocks")).cast("long")
    quota = F.coalesce(F.least(wanted, int(most) * F.col("blocks")), F.lit(0))
    aimed = write_table(aimed.withColumns({"quota": quota, "group": F.col("number") % groups}), "source-quotas")
    quotas = dict(aimed.groupBy("group").agg(F.sum("quota")).collect())
    order = sorted(quotas)
    totals = dict(zip(order, deal([quotas[g] for g in order], shards, [seed]).T, strict=True))

    def dealt(key: tuple, table: pa.Table) -> pa.Table:
        table, group = table.sort_by("number"), key[0].as_py()
        counts = deal(table.column("quota").to_pylist(), shards, [seed, group], totals[group])
        starts = np.concatenate((np.zeros((1, table.num_rows), np.int64), counts.cumsum(0))).T
        columns = [table.column(name) for name in ("source", "number", "size", "blocks", "target", "quota")]
        starts = pa.array([row.tobytes() for row in np.ascontiguousarray(starts)], pa.binary())
        return pa.Table.from_arrays(
            [*columns, starts], ["source", "number", "source_size", "source_blocks", "target", "quota", "starts"]
        )

    return write_table(aimed.groupBy("group").applyInArrow(dealt, _PLAN), "source-plan")


def _placed(sized: DataFrame) -> DataFrame:
    """Adds ``start``: the number of blocks of the source before the document's.

    Equal rows are counted first. Documents are dealt to runs by hash; sums are taken inside
    each run, and over the runs of a source.
    """
    alike = sized.groupBy("source", "doc_id", "mark", "size", "blocks").agg(F.count("*").alias("copies"))
    runs = max(1, sized.count() // RUN_ROWS)
    alike = alike.withColumn("run", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(runs)))
    alike = alike.withColumn("all_blocks", F.col("copies") * F.col("blocks"))
    in_run = Window.partitionBy("source", "run").orderBy("doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("inside", F.coalesce(F.sum("all_blocks").over(in_run), F.lit(0)))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        alike.groupBy("source", "run").agg(F.sum("all_blocks").alias("n"))
        .select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    joined = alike.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r")))
    return joined.select("source", "doc_id", "mark", "size", "blocks", "copies", (F.col("before") + F.col("inside")).alias("start"))


_DRAWN = (
    "doc_id long, source string, mark long, size long, source_size long, target double, taken long, "
    "blocks array<struct<shard:int,slot:long,first_word:long,words:long>>"
)


def mix(documents: DataFrame, *, block_words: int = BLOCK_WORDS, seed: int = 7, **options) -> DataFrame:
    """One row per row of ``documents``: doc_id, source, mark, size, source_size, target, taken, blocks.

    ``blocks`` lists what the mix takes of the document: shard, slot in the source's quota, first
    word and words; a block taken in two passes is listed twice. ``mark`` is a hash of the text. A
    NULL text has size 0 and gives no block, and so does every document of a source without
    words, whose target is 0. NULL is a source of its own, the last; any number of sources will do. Equal
    rows have places of their own. The result follows from the rows and the seed, not from their
    order. An empty table gives an empty result. ``options`` are those of ``plan``.

    Runs jobs, and keeps sizes, the plan and the result in the shared folder.
    """
    sized = write_table(_sized(documents, block_words), "sizes")
    made = plan(sized, seed=seed, **options)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                copies = batch.column("copies").to_numpy()
                row = np.repeat(np.arange(batch.num_rows), copies)
                turn = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                blocks = batch.column("blocks").to_numpy()[row]
                start = batch.column("start").to_numpy()[row] + turn * blocks
                of_row = batch.column("number").to_numpy()
                source = of_row[row]
                size = batch.column("size").to_numpy()[row]
                owner = np.repeat(np.arange(len(row)), blocks)
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                places, slots, shards = [], [], []
                by_source = np.argsort(source[owner], kind="stable")
                numbers, at = np.unique(of_row, return_index=True)
                bounds = np.searchsorted(source[owner], [numbers, numbers + 1], sorter=by_source)
                for s, k, low_at, high_at in zip(numbers.tolist(), at.tolist(), *bounds.tolist(), strict=True):
                    mine = by_source[low_at:high_at]
                    size_of, quota = (batch.column(name)[k].as_py() for name in ("source_blocks", "quota"))
                    taken, slot = _slots(start[owner[mine]] + inside[mine], size_of, quota, seed * 1009 + s)
                    starts = np.frombuffer(batch.column("starts")[k].as_py(), np.int64)
                    places.append(mine[taken])
                    slots.append(slot)
                    shards.append(np.searchsorted(starts, slot, "right") - 1)
                place = np.concatenate(places) if places else np.empty(0, np.int64)
                slot = np.concatenate(slots) if slots else place
                shard = np.concatenate(shards) if shards else place
                order = np.lexsort((slot, place))
                place, slot, shard = place[order], slot[order], shard[order]
                first = inside[place] * block_words
                words = np.minimum(size[owner[place]] - first, block_words)
                number_taken = np.bincount(owner[place], minlength=len(row))
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(number_taken))), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(shard, pa.int32()), pa.array(slot), pa.array(first), pa.array(words)],
                        ["shard", "slot", "first_word", "words"],
                    ),
                )
                total = np.bincount(owner[place], words, minlength=len(row)).astype(np.int64)
                picked = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(picked), batch.column("source").take(picked),
                        batch.column("mark").take(picked), pa.array(size),
                        batch.column("source_size").take(picked), batch.column("target").take(picked),
                        pa.array(total), listed,
                    ],
                    ["doc_id", "source", "mark", "size", "source_size", "target", "taken", "blocks"],
                )

    rows = join_splittable(_placed(sized), made, ["source"], null_safe=True)
    with ragged.batches_of(documents.sparkSession, BATCH_BYTES):
        return write_table(rows.mapInArrow(drawn, _DRAWN), "mixed-blocks")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each of the ``blocks`` of a text, with its words."""
    for batch in batches:
        for part, data, offsets in ragged.slices(batch, "text"):
            words = ragged.Words(data, offsets)
            blocks = part.column("blocks")
            owner = np.repeat(np.arange(part.num_rows), blocks.value_lengths().to_numpy())
            shard, slot, first, count = (blocks.flatten().field(k) for k in range(4))
            low = words.first[owner] + first.to_numpy()
            raw, texts = data.tobytes(), []
            for begin, end in zip(low.tolist(), (low + count.to_numpy()).tolist(), strict=True):
                spans = zip(words.starts[begin:end].tolist(), words.ends[begin:end].tolist(), strict=True)
                texts.append(b" ".join(raw[x:y] for x, y in spans).decode())
            picked = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [shard, part.column("doc_id").take(picked), part.column("source").take(picked), slot, pa.array(texts, pa.string())],
                ["shard", "doc_id", "source", "slot", "text"],
            )


def shard_texts(documents: DataFrame, *, seed: int = 7, **options) -> DataFrame:
    """(shard, doc_id, source, text) of each block the mix takes, by shard and shuffled inside.

    The text of a block is its words with single blanks. The rows come in order of the shard and of
    a hash; a large shard covers several tasks, one after the other.
    """
    taken = mix(documents, seed=seed, **options).where(F.size("blocks") > 0).select("doc_id", "source", "mark", "blocks")
    texts = documents.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("m"), "text")
    texts = texts.groupBy("d", "m").agg(F.min("text").alias("text"))
    joined = taken.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))
    mixed = joined.select("doc_id", "source", "blocks", "text").mapInArrow(
        _pieces, "shard int, doc_id long, source string, slot long, text string"
    )
    order = ["shard", F.xxhash64(F.lit(seed), "source", "slot")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select("shard", "doc_id", "source", "text")
