"""Language by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to three bytes with the counts of the byte
that follows. The cost of a byte is that of the longest context of the tree that matches:
seen there, its share of the counts; unseen, an escape, then the next shorter context, down
to one in 256. Counts are taken by Spark over all training texts and then frozen; no context
is left out.

A cost is a sum: what every context met adds for its escape, and what every byte seen in it adds
beyond that (its cost there, less the escape and less its cost in the shorter context). So
the tree is a table of numbers by language and key, which may be cut anywhere. It is cut into parts
of bounded size by a hash; each is handed to all tasks in turn, and a text's code lengths are the
sums over parts. A text's language is the one with the shortest code length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import ragged
from tidemill.llm.held_out import fold, held_out
from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
# Numbers of the tree, of 16 bytes each, that a task holds at a time; more of them take more passes.
PART_ENTRIES = 4_000_000
_ORDER = 3
# A key is the number of bytes before, whether it is the context itself, and the bytes, the last one lowest.
_ORDER_BIT, _CONTEXT = 33, 1 << 32


@dataclass(frozen=True)
class Model:
    """A part of the tree: its keys in order, and for each from ``first`` on the languages' numbers and bits."""

    languages: list[str]
    keys: np.ndarray
    first: np.ndarray
    number: np.ndarray
    bits: np.ndarray

    def _add(self, costs: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> None:
        """Adds to the ``rows`` of ``costs`` what the part has for the keys ``wanted``."""
        if not len(self.keys) or not len(wanted):
            return
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        at, rows = at[hit], rows[hit]
        times = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.cumsum(times) + times, times) + np.arange(times.sum())
        cell = np.repeat(rows, times) * costs.shape[1] + self.number[entry]
        # A language has a key once, so no cell is met twice.
        costs.reshape(-1)[cell] += self.bits[entry]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """What the part adds to the bits of each text of a slice under each language."""
        lengths = np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(data):
            return lengths
        symbol = ragged.LOWER[data].astype(np.uint64)
        depth = np.minimum(np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets)), _ORDER)
        run = symbol.copy()
        for k in range(1, _ORDER + 1):
            run[k:] |= np.where(depth[k:] >= k, symbol[:-k] << np.uint64(8 * k), np.uint64(0))
        kinds, which = np.unique(depth.astype(np.uint64) << np.uint64(32) | run, return_inverse=True)
        depth, run = (kinds >> np.uint64(32)).astype(np.int64), (kinds & np.uint64(0xFFFFFFFF)).astype(np.int64)
        costs = np.zeros((len(kinds), len(self.languages)))
        for k in range(_ORDER + 1):
            rows = np.flatnonzero(depth >= k)
            order = k << _ORDER_BIT
            own = run[rows] & ((1 << 8 * (k + 1)) - 1)
            self._add(costs, rows, order | own)
            self._add(costs, rows, order | _CONTEXT | own >> 8)
        for n in range(len(self.languages)):
            lengths[:, n] = ragged.per_document(np.ascontiguousarray(costs[:, n])[which], offsets)
        return lengths


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, times): runs of up to four bytes, coded with their length, of each language."""
    kept: dict[str, list] = {}

    def fold_in(lang: str) -> None:
        keys = np.concatenate([k for k, _ in kept[lang]])
        times = np.concatenate([t for _, t in kept[lang]])
        order = np.argsort(keys, kind="stable")
        keys, sizes = ragged.sorted_runs(keys[order])
        kept[lang] = [(keys, np.add.reduceat(times[order], np.cumsum(sizes) - sizes))]

    for batch in batches:
        for part, data, offsets in ragged.slices(batch, "text"):
            names = np.array(part.column("lang").to_pylist(), dtype=object)
            code = ragged.LOWER[data].astype(np.uint32)
            depth = np.arange(len(code)) - np.repeat(offsets[:-1], np.diff(offsets))
            owner = np.repeat(names, np.diff(offsets)) if len(set(names)) > 1 else None
            gram = code.copy()
            for k in range(1, _ORDER + 1):
                gram[k:] |= code[:-k] << np.uint32(8 * k)
            for lang in dict.fromkeys(names):
                mine = slice(None) if owner is None else owner == lang
                full, at = gram[mine], depth[mine]
                found = [np.sort(full[at >= _ORDER]).astype(np.uint64) | np.uint64(_ORDER << 32)]
                for k in range(_ORDER):
                    head = full[at == k] & np.uint32((1 << 8 * (k + 1)) - 1)
                    found.append(np.sort(head).astype(np.uint64) | np.uint64(k << 32))
                for keys in found:
                    if len(keys):
                        kept.setdefault(lang, []).append(ragged.sorted_runs(keys))
                if sum(len(k) for k, _ in kept.get(lang, [])) > 2_000_000:
                    fold_in(lang)
    for lang in kept:
        fold_in(lang)
        for keys, times in kept[lang]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(times)],
                ["lang", "gram", "times"],
            )


def _counts(documents: DataFrame) -> DataFrame:
    """(lang, order, context, byte, times) over all texts with a language outside the held-out fold."""
    outside = F.coalesce(fold("doc_id", FOLDS) != HELD_OUT, F.lit(True))
    chosen = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & outside)
    counts = (
        chosen.select("lang", "text")
        .mapInArrow(_grams, "lang string, gram long, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
    )
    # A text's first bytes have short contexts only; longer runs hold their own shorter ones.
    order = F.shiftright("gram", 32)
    low = F.col("gram").bitwiseAND((1 << 32) - 1)
    lengths = F.explode(F.sequence(F.lit(0), order.cast("int"))).alias("order")
    # (order, context, byte): the last byte and up to three before it.
    counts = counts.select("lang", "times", low.alias("run"), lengths)
    context = F.shiftright("run", 8).bitwiseAND(F.expr("shiftleft(1L, 8 * order) - 1"))
    counts = counts.select("lang", "order", context.alias("context"), F.col("run").bitwiseAND(255).alias("byte"), "times")
    return counts.groupBy("lang", "order", "context", "byte").agg(F.sum("times").alias("times"))


def entries(documents: DataFrame) -> DataFrame:
    """(lang, key, bits): the whole tree, with the cost of an escape for each context and what a byte
    seen there differs from that. Runs jobs, and keeps the counts in the shared folder."""
    counts = write_table(_counts(documents), "byte-contexts")
    place = ["lang", "order", "context"]
    totals = counts.groupBy(*place).agg(F.sum("times").alias("total"), F.count("*").alias("kinds"))
    whole = F.col("total") + F.col("kinds")
    # Escape with the share of new bytes seen in the context; before any context a byte costs 8 bits.
    escape = F.log2(whole / F.col("kinds")) + F.when(F.col("order") == 0, 8.0).otherwise(0.0)
    totals = write_table(totals.select(*place, whole.alias("whole"), escape.alias("escape")), "contexts")
    seen = counts.join(totals, place).select(*place, "byte", "escape", F.log2(F.col("whole") / F.col("times")).alias("cost"))
    shorter = F.col("context").bitwiseAND(F.expr("shiftleft(1L, 8 * (order - 1)) - 1"))
    first, longer = seen.where("order = 0"), seen.where("order > 0").withColumn("shorter", shorter)
    below = seen.select(
        "lang", (F.col("order") + 1).alias("order"), F.col("context").alias("shorter"), "byte", F.col("cost").alias("below")
    )
    longer = longer.join(below, ["lang", "order", "shorter", "byte"])
    order = F.shiftleft(F.col("order").cast("long"), _ORDER_BIT)
    symbol = order.bitwiseOR(F.shiftleft("context", 8)).bitwiseOR(F.col("byte"))
    return (
        totals.select("lang", order.bitwiseOR(F.lit(_CONTEXT)).bitwiseOR(F.col("context")).alias("key"), F.col("escape").alias("bits"))
        .unionByName(first.select("lang", symbol.alias("key"), (F.col("cost") - F.col("escape")).alias("bits")))
        .unionByName(longer.select("lang", symbol.alias("key"), (F.col("cost") - F.col("below") - F.col("escape")).alias("bits")))
    )


def _part(table: DataFrame, languages: list[str]) -> Model:
    rows = table.toPandas()
    number = np.searchsorted(np.array(languages, dtype=object), rows["lang"].to_numpy(object)) if len(rows) else np.empty(0)
    number, key = number.astype(np.int32), rows["key"].to_numpy(np.int64)
    order = np.lexsort((number, key))
    keys, times = ragged.sorted_runs(key[order])
    first = np.concatenate(([0], np.cumsum(times)))
    return Model(languages, keys, first, number[order], rows["bits"].to_numpy(np.float64)[order])


def trained(documents: DataFrame, *, part_entries: int = PART_ENTRIES) -> tuple[list[str], int, DataFrame]:
    """The languages, the number of parts, and the tree as (lang, key, bits, part).

    A part has ``part_entries`` numbers at most but for the chance of hashing, for which a quarter is left.
    """
    tree = write_table(entries(documents), "byte-costs")
    languages = sorted(row["lang"] for row in tree.select("lang").distinct().collect())
    parts = 1 + tree.count() * 5 // (part_entries * 4)
    tree = tree.withColumn("part", F.pmod(F.xxhash64("lang", "key"), F.lit(parts)).cast("int"))
    if parts > 1:
        # Files in order of the part, so that a part is read without the others.
        tree = write_table(tree.repartitionByRange("part").sortWithinPartitions("part"), "byte-cost-parts")
    return languages, parts, tree


def train(documents: DataFrame) -> Model:
    """The tree as one part, whatever its size; for corpora whose tree fits the driver."""
    languages, _, tree = trained(documents)
    return _part(tree.drop("part"), languages)


def _lengths_under(model: Model, text: str | Column) -> Column:
    @F.arrow_udf("array<double>")
    def lengths(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        width = len(model.languages)
        for column in texts:
            found = [np.empty((0, width))]
            for _, data, offsets in ragged.slices(pa.record_batch([column], ["text"]), "text"):
                found.append(model.code_lengths(data, offsets))
            flat = np.concatenate(found)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * width), pa.array(flat.ravel()))

    return lengths(text)


def _summed(documents: DataFrame, languages: list[str], parts: int, tree: DataFrame) -> DataFrame:
    """(text_a, text_b, lengths): the sums over all parts for each different text, known by two hashes.

    One pass over the texts for each part, written before the next, so that one part is held at a time.
    """
    marked = documents.select(F.xxhash64("text").alias("text_a"), F.xxhash64("text", F.lit(1)).alias("text_b"), "text")
    found = None
    for part in range(parts):
        model = _part(tree.where(F.col("part") == part).drop("part"), languages)
        one = marked.select("text_a", "text_b", F.lit(part).alias("part"), _lengths_under(model, "text").alias("lengths"))
        # Equal texts have equal lengths.
        one = write_table(one.groupBy("text_a", "text_b", "part").agg(F.max("lengths").alias("lengths")), "lengths")
        found = one if found is None else found.unionByName(one)
    listed = found.groupBy("text_a", "text_b").agg(F.array_sort(F.collect_list(F.struct("part", "lengths"))).alias("all"))
    zeros = F.array_repeat(F.lit(0.0), len(languages))
    total = F.aggregate("all", zeros, lambda sums, x: F.zip_with(sums, x["lengths"], lambda a, b: a + b))
    return write_table(listed.select("text_a", "text_b", total.alias("lengths")), "lengths")


def predict_language(documents: DataFrame, *, part_entries: int = PART_ENTRIES) -> DataFrame:
    """``documents`` with ``held_out``, ``lang_pred`` and ``score`` in place of their own such columns.

    The score is the share of the predicted language when all are equally likely beforehand. A
    text that is NULL or has no letter is ``und`` with score 0, and so is every text when
    no text with a language is there to learn from. Equal code lengths go to the first language
    by code point. Each of several equal rows is scored; an empty table gives an empty result.

    Runs jobs, and keeps counts and the tree in the shared folder. The driver holds the names of the languages and
    one part of the tree at a time; a tree of several parts takes a pass over the texts for each.
    """
    languages, parts, tree = trained(documents, part_entries=part_entries)
    names = documents.columns
    row = F.struct(*names).alias("row")
    if parts == 1:
        model = _part(tree.drop("part"), languages)
        scored = documents.select(row, _lengths_under(model, "text").alias("lengths"))
    else:
        sums = _summed(documents, languages, parts, tree)
        marked = documents.select(row, F.xxhash64("text").alias("text_a"), F.xxhash64("text", F.lit(1)).alias("text_b"))
        scored = join_splittable(marked, sums, ["text_a", "text_b"], "left")

    def decided(lengths: Column) -> Column:
        least = F.array_min(lengths)
        shares = F.transform(lengths, lambda x: F.pow(F.lit(2.0), -F.least(x - least, F.lit(1000.0))))
        lang = F.get(F.lit(languages) if languages else F.array().cast("array<string>"), F.array_position(lengths, least).cast("int") - 1)
        return F.struct(lang.alias("lang"), F.try_divide(F.lit(1.0), F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)).alias("score"))

    # The list of one gives the lengths a name, so that they are not made again for each use.
    scored = scored.select("row", F.transform(F.array("lengths"), decided)[0].alias("found"))
    usable = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False)) & F.col("found.lang").isNotNull()
    new = {
        "held_out": held_out("row.doc_id", FOLDS, HELD_OUT),
        "lang_pred": F.when(usable, F.col("found.lang")).otherwise(UNKNOWN),
        "score": F.when(usable, F.col("found.score")).otherwise(0.0),
    }
    kept = [new.pop(name).alias(name) if name in new else F.col("row")[name].alias(name) for name in names]
    return scored.select(*kept, *[column.alias(name) for name, column in new.items()])
