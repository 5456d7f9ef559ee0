"""Near-duplicate groups by SuperMinHash signatures.

Each element ranks all signature components by a permutation of its own: component
``(start + step * j) mod m`` has rank ``j`` plus a fraction. A component keeps the least value
of all elements. Ranks of one element differ between components, so the components are
negatively correlated and estimates vary less than with independent hashes; and as values of
round ``j`` are at least ``j``, a document is done as soon as all its components are lower.
With ``m`` a prime and any step but 0 the ranks are a permutation.

Signatures are cut into bands. Documents with the same set of shingles become one class
first. In each band's bucket, classes are compared with one centre, not with each other, and who is
left apart with a few of the bucket's largest group. What this leaves outside that group is compared
with all others of the bucket on the full shingle sets, a block of texts with a block of texts in a
task, so that a text is a row for each block and not for each pair. Links are confirmed on the full
shingle sets, and groups found by union-find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm import ragged
from tidemill.llm.components import components
from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

# 32 bands of 5: a pair at 0.8 is missed with a chance of (1 - 0.8 ** 5) ** 32, 3 in a million.
BANDS, BAND_ROWS = 32, 5
# A prime of at least BANDS * BAND_ROWS.
COMPONENTS = 163
# Numbers of 32 components a sketch takes.
SKETCH = BANDS * BAND_ROWS // 32
# Of the components' last two bits, a pair at 0.8 has 24 of 160 different, with a deviation of
# at most 4.5; pairs with more than this many are not fetched for comparison.
DIFFERENT = 50
_EMPTY = np.uint32(0xFFFFFFFF)
# Bytes of texts, or of pairs of texts, handed to Python together, and of a slice of them.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 1 << 19
# Shingles of the texts of a block; a longer text is a block of its own, with a few others at most.
BLOCK_SHINGLES = 1 << 17
# Size of the filter of documents in shared buckets at most: 16 MB.
FILTER_BITS = 1 << 27


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where each text's begin.

    A shingle is ``size`` words in lower case (A to Z); a text with fewer words has one, all
    its words; a text without words has none.
    """
    words = ragged.Words(ragged.LOWER[data], offsets)
    hashes, first = words.hashes(), words.first
    runs = ragged.ngram_hashes(hashes, size) if len(hashes) >= size else np.empty(0, np.uint64)
    found = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= size:
            own = np.sort(runs[low : high - size + 1])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
        elif high > low:
            own = ragged.ngram_hashes(hashes[low:high], high - low) ^ np.uint64(high - low)
        else:
            own = hashes[:0]
        found.append(own)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate(found) if found else hashes[:0], np.concatenate(([0], np.cumsum(sizes)))


def signatures(elements: np.ndarray, first: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """SuperMinHash signature of each set: rank in the high byte, fraction in 24 bits."""
    n = len(first) - 1
    least = np.full(n * m, _EMPTY, np.uint32)
    owner = np.repeat(np.arange(n) * m, np.diff(first))
    element = ragged.mix(elements)
    component = (element % np.uint64(m)).astype(np.int64)
    step = 1 + ((element >> np.uint64(32)) % np.uint64(m - 1)).astype(np.int64)
    for j in range(m):
        if not len(element):
            break
        fraction = (ragged.mix(element + np.uint64((j + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(40)).astype(np.uint32)
        np.minimum.at(least, owner + component, fraction | np.uint32(j << 24))
        component += step
        component[component >= m] -= m
        highest = least.reshape(n, m).max(1) >> np.uint32(24)
        open_ = (highest > j)[owner // m]
        if not open_.all():
            owner, element, component, step = owner[open_], element[open_], component[open_], step[open_]
    return least.reshape(n, m)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    n = len(signature)
    rows = signature[:, : BANDS * BAND_ROWS].reshape(n, BANDS, BAND_ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32), (n, 1))
    for k in range(BAND_ROWS):
        key = ragged.mix(key + rows[:, :, k])
    return key.astype(np.int64)


def _sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of each banded component, 32 components to a number."""
    lanes = (signature[:, : BANDS * BAND_ROWS] & 3).astype(np.uint64).reshape(len(signature), SKETCH, 32)
    return (lanes << (2 * np.arange(32, dtype=np.uint64))).sum(2, dtype=np.uint64).astype(np.int64)


_SIGNED = "id long, n_shingles long, mark_a long, mark_b long, bands array<long>, " + ", ".join(
    f"sketch_{k} long" for k in range(SKETCH)
)


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ragged.slices(batch, "text", SLICE_BYTES):
                elements, first = shingles(data, offsets, size)
                count = np.diff(first)
                marks = []
                for salt in (0x1234567, 0x7654321):
                    sums = np.zeros(len(elements) + 1, np.uint64)
                    np.cumsum(ragged.mix(elements ^ np.uint64(salt)), out=sums[1:])
                    marks.append((sums[first[1:]] - sums[first[:-1]]).astype(np.int64))
                signature = signatures(elements, first)
                keys = _band_keys(signature)
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(count) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(count), pa.array(marks[0]), pa.array(marks[1]), keys,
                        *[pa.array(column) for column in np.ascontiguousarray(_sketch(signature).T)],
                    ],
                    ["id", "n_shingles", "mark_a", "mark_b", "bands", *[f"sketch_{k}" for k in range(SKETCH)]],
                )

    return run


def _alike(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for part, data, offsets in ragged.slices(batch, "text_a", SLICE_BYTES):
                left, first_a = shingles(data, offsets, size)
                inner = []
                for other, data_b, offsets_b in ragged.slices(part, "text_b", SLICE_BYTES):
                    right, first_b = shingles(data_b, offsets_b, size)
                    for k in range(other.num_rows):
                        a = left[first_a[len(inner)] : first_a[len(inner) + 1]]
                        b = right[first_b[k] : first_b[k + 1]]
                        small, large = min(len(a), len(b)), max(len(a), len(b))
                        if not small or 100 * small < percent * large:
                            inner.append(False)
                            continue
                        both = np.sort(np.concatenate((a, b)))
                        shared = int((both[1:] == both[:-1]).sum())
                        inner.append(100 * shared >= percent * (len(a) + len(b) - shared))
                linked += inner
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _linked(size: int, percent: int):
    """Links of the outsiders of each block to its other rows; rows come sorted by block, outsiders first.

    One link of an outsider to each other group is enough to join the groups.
    """

    def linked(rows: pa.RecordBatch, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        parts = [shingles(data, offsets, size) for _, data, offsets in ragged.slices(rows, "text", SLICE_BYTES)]
        elements = np.concatenate([part for part, _ in parts])
        sizes = np.concatenate([np.diff(first) for _, first in parts])
        first = np.concatenate(([0], np.cumsum(sizes)))
        ids, groups = rows.column("id").to_numpy(), rows.column("component").to_numpy()
        others = np.concatenate(([0], np.cumsum(rows.column("side").to_numpy() == 0)))
        left, right = [], []
        for low, high in zip(bounds, bounds[1:], strict=False):
            split = low + int(others[high] - others[low])
            if split == low or split == high:
                continue
            different, codes = np.unique(elements[first[low] : first[high]], return_inverse=True)
            begin = first[low : high + 1] - first[low]
            theirs, ends = codes[begin[split - low] :], begin[split - low :] - begin[split - low]
            mark = np.zeros(len(different), np.int32)
            for k in range(low, split):
                own = codes[begin[k - low] : begin[k - low + 1]]
                mark[own] = 1
                shared = ragged.per_document(mark[theirs], ends)
                mark[own] = 0
                alike = (shared > 0) & (100 * shared >= percent * (len(own) + sizes[split:high] - shared))
                found = np.flatnonzero(alike & (groups[split:high] != groups[k]))
                if len(found):
                    found = found[np.unique(groups[split:high][found], return_index=True)[1]]
                    left += [int(ids[k])] * len(found)
                    right += ids[split:high][found].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            block = np.stack([batch.column(name).to_numpy() for name in _BLOCK], 1)
            begins = np.flatnonzero(np.any(block[1:] != block[:-1], axis=1)) + 1
            if kept and any(kept[-1].column(name)[-1] != batch.column(name)[0] for name in _BLOCK):
                begins = np.append(0, begins)
            if len(begins):
                # Blocks that end in this batch, the first with its rows of batches before.
                head = pa.Table.from_batches([*kept, batch.slice(0, int(begins[-1]))]).combine_chunks().to_batches()[0]
                before = head.num_rows - int(begins[-1])
                yield from linked(head, [0, *(before + begins).tolist()])
                kept = []
            kept.append(batch.slice(int(begins[-1]) if len(begins) else 0))
        if kept:
            last = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            yield from linked(last, [0, last.num_rows])

    return run


_BLOCK = ["key", "theirs", "ours"]


def _carried() -> list[str]:
    """What is compared before texts: the number of shingles and the sketch."""
    return ["n_shingles", *[f"sketch_{k}" for k in range(SKETCH)]]


def _may_be_alike(percent: int) -> Column:
    """Whether a row's numbers of shingles and sketch, and those with the prefix ``own_``, allow the similarity."""
    different = F.lit(0)
    for name in _carried()[1:]:
        bits = F.col(name).bitwiseXOR(F.col(f"own_{name}"))
        different = different + F.bit_count(bits.bitwiseOR(F.shiftright(bits, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    sizes = (F.col("n_shingles"), F.col("own_n_shingles"))
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (different <= DIFFERENT)


def _own(rows: DataFrame, *named: Column) -> DataFrame:
    return rows.select(*named, *[F.col(name).alias(f"own_{name}") for name in _carried()])


def _confirmed(pairs: DataFrame, plain: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the (a, b) whose full shingle sets are similar enough; ``plain``: id, text."""
    texts = plain.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_alike(size, percent), "a long, b long")


def _maybe_in(wanted: DataFrame):
    """Leaves out texts whose ``id`` surely is not in ``wanted``, by a Bloom filter.

    The filter has 16 bits an id but at most ``FILTER_BITS``; a full one lets everything through, which is only slower.
    """
    bits = min(max(1 << (16 * wanted.count()).bit_length(), 1 << 10), FILTER_BITS)
    mixed = F.xxhash64("id")
    places = F.array(mixed.bitwiseAND(bits - 1), F.shiftrightunsigned(mixed, 32).bitwiseAND(bits - 1))
    words = (
        wanted.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
        .toPandas()
    )
    filled = np.zeros(bits // 64, np.uint64)
    filled[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint64)
    shipped = wanted.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("mixed").to_numpy().view(np.uint64)
            keep = np.ones(len(hashes), bool)
            for place in (hashes, hashes >> np.uint64(32)):
                place = place & np.uint64(bits - 1)
                keep &= (shipped.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield batch.select(["id", "text"]).filter(pa.array(keep))

    return run


def _open_buckets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (key, id, component, top) of the buckets that hold several groups; ``top`` is the largest, of ``top_size``."""
    named = groups.select(F.col("id").alias("known"), "component")
    placed = members.join(named, members["id"] == named["known"], "left").select(
        "key", "id", F.coalesce("component", "id").alias("component"), *_carried()
    )
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("groups"))
        .where("groups > 1")
        .select("key", F.col("top.component").alias("top"), F.col("top.size").alias("top_size"))
    )
    return join_splittable(placed, largest, ["key"])


def _majority_pairs(open_: DataFrame, turn: int, partners: int, percent: int) -> DataFrame:
    """Pairs of each member outside its buckets' largest groups with a few of one of those, others each ``turn``.

    A member of a family joins it by one link, whichever member that is with, and most have a link with
    a good part of the family: a few pairs for each, in one bucket of all it is in.
    """
    best = Window.partitionBy("id").orderBy(F.desc("top_size"), "key")
    outside = open_.where(F.col("component") != F.col("top")).withColumn("turn", F.row_number().over(best))
    first = _own(outside.where("turn = 1"), F.col("key").alias("at"), F.col("id").alias("outsider"))
    some = Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(turn)), "id")
    inside = open_.where(F.col("component") == F.col("top")).withColumn("turn", F.row_number().over(some))
    met = inside.where(F.col("turn") <= partners).join(first, (F.col("key") == F.col("at")) & _may_be_alike(percent))
    return met.select(F.least("outsider", "id").alias("a"), F.greatest("outsider", "id").alias("b"))


def _links_apart(open_: DataFrame, plain: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of different groups that share a bucket of ``open_``.

    Of two members of different groups at least one is outside the largest. Those are dealt to blocks,
    as are all members, by hash and by the number of shingles in the bucket, and each block of the
    one meets each block of the other.
    """
    apart = F.col("component") != F.col("top")
    blocks = lambda n: F.ceil(n / BLOCK_SHINGLES).cast("int")
    dealt = open_.groupBy("key").agg(
        blocks(F.sum(F.when(apart, F.col("n_shingles")))).alias("n_ours"), blocks(F.sum("n_shingles")).alias("n_theirs")
    )
    placed = join_splittable(open_.select("key", "id", "component", "top", "n_shingles"), dealt, ["key"])
    mixed = F.xxhash64("id", "key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ours = placed.where(apart).select(
        "key", every("n_theirs").alias("theirs"), F.pmod(mixed, "n_ours").cast("int").alias("ours"), F.lit(0).alias("side"), "id", "component"
    )
    theirs = placed.select(
        "key", F.pmod(mixed, "n_theirs").cast("int").alias("theirs"), every("n_ours").alias("ours"), F.lit(1).alias("side"), "id", "component"
    )
    met = ours.select(*theirs.columns).unionByName(theirs)
    texts = plain.join(open_.select("id").distinct(), "id", "left_semi")
    rows = met.join(texts.withColumnRenamed("id", "known"), F.col("id") == F.col("known")).drop("known")
    rows = rows.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "side")
    return rows.mapInArrow(_linked(size, percent), "a long, b long")


def near_duplicates(documents: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``documents``.

    Two documents are linked if ``100 * shared >= percent * all`` of their distinct shingles.
    ``component_id`` is the least ``doc_id`` a document can reach, ``kept`` marks that one. A NULL or
    empty text, and one without words, has no shingles and no links. Rows that share a
    ``doc_id`` count as one document with the links of all of them. A row without ``doc_id``
    has no component and is kept. An empty table gives an empty result.

    Runs jobs, and keeps signatures, buckets and links in the shared folder.
    """
    plain = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    with ragged.batches_of(documents.sparkSession, BATCH_BYTES):
        signed = write_table(plain.mapInArrow(_signed(size), _SIGNED), "signatures")
        groups = _groups(plain, signed, size, percent)
    counted = signed.select(F.col("id").alias("doc_id"), "n_shingles")
    found = counted.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(documents: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` without those for which a near-duplicate with a smaller ``doc_id`` stays."""
    found = near_duplicates(documents, size=size, percent=percent)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)


def _groups(plain: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, component) of the documents that are linked with any other."""
    filled = signed.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    marks = ["n_shingles", "mark_a", "mark_b"]
    classes = write_table(filled.groupBy(*marks).agg(F.min("id").alias("rep"), F.max("id").alias("last")), "classes")
    copies = join_splittable(filled.select("id", *marks), classes.where("rep < last"), marks)
    copies = copies.where("id > rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    one_each = filled.join(classes.select(F.col("rep").alias("id"), *marks), ["id", *marks])
    exploded = one_each.select("id", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last")
    shared = join_splittable(exploded, shared, ["key"]).select("key", "id", "centre")
    carried = one_each.select(F.col("id").alias("known"), *_carried())
    members = shared.join(carried, F.col("id") == F.col("known")).drop("known")
    members = write_table(members, "buckets")
    # What follows reads the texts that are in any bucket with others, and shuffles no more than those.
    wanted = write_table(members.select("id").distinct(), "bucket-ids")
    likely = plain.withColumn("mixed", F.xxhash64("id")).mapInArrow(_maybe_in(wanted), "id long, text string")
    plain = write_table(likely.join(wanted, "id", "left_semi"), "bucket-texts")
    compared = members.where("id > centre").select(F.col("centre").alias("a"), "id", *_carried()).distinct()
    first = _own(carried, F.col("known"))
    compared = compared.join(first, (F.col("a") == F.col("known")) & _may_be_alike(percent))
    compared = write_table(compared.select("a", F.col("id").alias("b")).distinct(), "pairs")
    # Written first, as a task would hold two Python workers if union-find read them from the comparison.
    links = write_table(_confirmed(compared, plain, size, percent), "links-found")
    groups = components(copies.unionByName(links))
    members, partners, turn, helps = members.drop("centre"), 4, 0, True
    while helps:
        open_ = write_table(_open_buckets(members, groups), "open-buckets")
        turn += 1
        pairs = _majority_pairs(open_, turn, partners, percent).join(compared, ["a", "b"], "left_anti")
        further = write_table(pairs, "pairs")
        tried = further.count()
        links = write_table(_confirmed(further, plain, size, percent), "links-found")
        known = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
        groups = components(known.unionByName(links))
        compared = compared.unionByName(further)
        # Few links for many pairs: who is left has none with most of the family, or none at all.
        helps = tried > 0 and links.count() * 8 >= tried
    open_ = write_table(_open_buckets(members, groups), "open-buckets")
    if open_.isEmpty():
        return groups
    links = write_table(_links_apart(open_, plain, size, percent), "links-found")
    known = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(links))
