"""Repeated runs of lines, by a suffix array over line numbers built by prefix doubling.

Every document is a sequence of lines. Round ``k`` holds, for each position whose run of ``2 ** k``
lines occurs more than once, the rank of that run among all such runs; the pair of ranks at
a position and ``2 ** k`` lines on gives the rank of the run twice as long. Equal ranks are the
intervals of the suffix array whose common prefix is at least that long. Positions whose run
is unique leave, so the work shrinks from round to round.

A run counts from a stated length on. Of each position the shortest runs of that length that
begin and end there are looked up: a run of ``n`` lines is named by the ranks of its first and of its
last ``2 ** k`` lines, ``2 ** k <= n < 2 ** (k + 1)``, and equal names are an interval with a common prefix
of ``n`` lines. In each interval all but the first occurrence are later copies. Every longer run is the
union of such runs inside it, so together they are exactly the maximal repeated runs, and no round
is needed beyond the stated length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table

_LAST = (1 << 63) - 1
_PLACE = ["owner", "copy", "pos"]
_WORD = r"[^\x20\x09-\x0D]"


def _owner() -> dict[str, Column]:
    """Number and text of a document as its key; a NULL number comes last."""
    return {"owner": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "copy": F.xxhash64("text")}


def _spans(min_lines: int, min_words: int):
    """Of each line, from the words of a document's lines: the lines of the shortest run long enough
    that begins there, and that ends there; 0 where the document is too short."""

    @F.arrow_udf("array<struct<ahead:int,back:int>>")
    def spans(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            first = np.concatenate(([0], np.cumsum(sizes)))
            after = np.cumsum(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            before = np.concatenate(([0], after[:-1])) if len(after) else after
            at = np.arange(len(after))
            low, high = np.repeat(first[:-1], sizes), np.repeat(first[1:], sizes)
            ahead = np.maximum(np.searchsorted(after, before + min_words) - at + 1, min_lines)
            back = np.maximum(at - np.searchsorted(before, after - min_words, "right") + 2, min_lines)
            ahead[at + ahead > high] = 0
            back[at - back + 1 < low] = 0
            both = pa.StructArray.from_arrays([pa.array(ahead, pa.int32()), pa.array(back, pa.int32())], ["ahead", "back"])
            yield pa.ListArray.from_arrays(pa.array(first, pa.int32()), both)

    return spans


def _lines(documents: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(owner, copy, pos, line_no, two hashes, ahead, back) of each line that has a word."""
    hashed = F.transform(
        F.split(F.col("text"), "\n", -1),
        lambda line, n: F.when(
            line.rlike(_WORD),
            F.struct(
                n.alias("line_no"), F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2"),
                F.regexp_count(line, F.lit(_WORD + "+")).alias("words"),
            ),
        ),
    )
    filled = F.filter(hashed, lambda x: x.isNotNull())
    listed = documents.select(*[c.alias(name) for name, c in _owner().items()], filled.alias("lines")).where("size(lines) > 0")
    spans = _spans(min_lines, min_words)(F.col("lines.words"))
    placed = listed.select("owner", "copy", F.posexplode(F.arrays_zip("lines", spans.alias("spans"))).alias("pos", "line"))
    return placed.select(
        "owner", "copy", "pos", "line.lines.line_no", "line.lines.h1", "line.lines.h2", "line.spans.ahead", "line.spans.back"
    )


def _repeated(rows: DataFrame, name: list[str]) -> DataFrame:
    """The rows whose ``name`` occurs at several places, with its rank and its first place.

    Names are sorted over all tasks, one row each; a rank is the number of a task and the row
    in it, so ranks are in the order of names without being dense.
    """
    groups = rows.groupBy(*name).agg(
        F.min(F.struct(*_PLACE)).alias("first"), F.max(F.struct(*_PLACE)).alias("last")
    )
    ranked = (
        groups.where("first < last")
        .select(*name, "first")
        .repartitionByRange(*name)
        .sortWithinPartitions(*name)
        .withColumn("rank", F.monotonically_increasing_id())
    )
    ranked = write_table(ranked, "ranks")
    placed = join_splittable(rows, ranked, name).select(*_PLACE, "line_no", "ahead", "back", "rank", "first")
    return write_table(placed.distinct(), "suffixes")


def _rounds(documents: DataFrame, min_lines: int, min_words: int, longest: int) -> Iterator[tuple[int, DataFrame]]:
    """(length, table) of each round up to ``longest`` lines: the places of repeated runs of that length.

    ``ahead`` belongs to the first line of the run, ``back`` to its last.
    """
    open_ = _repeated(_lines(documents, min_lines, min_words), ["h1", "h2"])
    length = 1
    while not open_.isEmpty():
        yield length, open_
        if 2 * length > longest:
            return
        then = open_.select(
            "owner", "copy", (F.col("pos") - length).alias("pos"), F.col("rank").alias("next"), F.col("back").alias("end")
        )
        pairs = open_.select(*_PLACE, "line_no", "ahead", F.col("rank").alias("head")).join(then, _PLACE)
        open_ = _repeated(pairs.withColumnRenamed("end", "back"), ["head", "next"])
        length *= 2


def repeated_runs(documents: DataFrame, *, min_lines: int = 1) -> DataFrame:
    """(owner, copy, pos, line_no, lines, source, source_copy, source_pos): for each position that begins
    a later copy, the longest run found there, a power of two of lines, and its first occurrence.

    Longer runs are chains of overlapping ones. Positions count lines with a word; others
    belong to no run. ``min_lines`` is a power of two. Equal rows of one ``doc_id`` and text are one document.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    runs = None
    for length, open_ in _rounds(documents, 1, 1, _LAST):
        later = open_.where(F.struct(*_PLACE) != F.col("first"))
        later = later.select(*_PLACE, "line_no", F.lit(length).alias("lines"), "first")
        if runs is None:
            runs = later.where(F.lit(length >= min_lines))
        elif length >= min_lines:
            runs = runs.unionByName(later)
    if runs is None:
        schema = "owner long, copy long, pos int, line_no int, lines int, source long, source_copy long, source_pos int"
        return documents.sparkSession.createDataFrame([], schema)
    longest = runs.groupBy(*_PLACE, "line_no").agg(F.max(F.struct("lines", "first")).alias("run"))
    return longest.select(
        *_PLACE, "line_no", "run.lines", F.col("run.first.owner").alias("source"),
        F.col("run.first.copy").alias("source_copy"), F.col("run.first.pos").alias("source_pos"),
    )


def later_copies(documents: DataFrame, *, min_lines: int = 1, min_words: int = 1) -> DataFrame:
    """(owner, copy, pos, lines, source, source_copy, source_pos) of the shortest runs of at least ``min_lines``
    lines and ``min_words`` words, beginning or ending at any line, that occur at an earlier place, with the first.

    Their union is every line of every run of that length that occurs earlier. The earlier place may be in the
    same document and overlap. Positions and lines are as in ``repeated_runs``.
    """
    if min_lines < 1 or min_words < 1:
        raise ValueError("min_lines and min_words must be 1 at least")
    found = None
    for length, open_ in _rounds(documents, min_lines, min_words, max(min_lines, min_words)):
        reach = F.lit(length)
        begins = open_.where(F.col("ahead").between(length, 2 * length - 1))
        ends = open_.where(F.col("back").between(length, 2 * length - 1))
        wanted = begins.select("owner", "copy", "pos", F.col("ahead").alias("lines")).unionByName(
            ends.select("owner", "copy", (F.col("pos") + reach - F.col("back")).alias("pos"), F.col("back").alias("lines"))
        ).distinct()
        ranks = open_.select("owner", "copy", F.col("pos"), "rank")
        named = wanted.join(ranks.withColumnRenamed("rank", "head"), _PLACE)
        named = named.withColumn("tail_pos", F.col("pos") + F.col("lines") - reach).join(
            ranks.withColumnsRenamed({"rank": "tail", "pos": "tail_pos"}), ["owner", "copy", "tail_pos"]
        )
        named = write_table(named.select(*_PLACE, "lines", "head", "tail"), "line-names")
        name = ["lines", "head", "tail"]
        firsts = named.groupBy(*name).agg(F.min(F.struct(*_PLACE)).alias("first"), F.max(F.struct(*_PLACE)).alias("last"))
        later = join_splittable(named, firsts.where("first < last").select(*name, "first"), name)
        later = later.where(F.struct(*_PLACE) != F.col("first")).select(
            *_PLACE, "lines", F.col("first.owner").alias("source"),
            F.col("first.copy").alias("source_copy"), F.col("first.pos").alias("source_pos"),
        )
        found = later if found is None else found.unionByName(later)
    if found is None:
        schema = "owner long, copy long, pos int, lines int, source long, source_copy long, source_pos int"
        return documents.sparkSession.createDataFrame([], schema)
    return found


def _without(text: Column, places: Column) -> Column:
    """``text`` without its lines at ``places`` among those with a word; in one pass, whatever the number of lines.

    The inner functions read their lists through the argument of an outer one, so that each list is made once.
    """

    def rebuilt(lines: Column) -> Column:
        worded = F.filter(F.transform(lines, lambda line, n: F.when(line.rlike(_WORD), n)), lambda n: n.isNotNull())
        gone = F.transform(F.array(worded), lambda numbers: F.transform(places, lambda p: F.get(numbers, p)))[0]
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda n: F.get(lines, n)), "\n")

    return F.transform(F.array(F.split(text, "\n", -1)), rebuilt)[0]


def remove_repeated_lines(documents: DataFrame, *, min_lines: int = 1, min_words: int = 1) -> DataFrame:
    """``documents`` with ``text`` without later copies of repeated runs, and ``n_lines`` and ``n_removed``.

    A line goes if it lies in a run of at least ``min_lines`` lines and ``min_words`` words, next to each other
    but for lines without a word, that occurs at an earlier place. Lines are what line feeds separate;
    documents are in order of ``doc_id``, a NULL one last, rows of one ``doc_id`` in order of a hash of the
    text. The first occurrence of a run stays. Lines without a word stay. A NULL text stays NULL with
    no lines; an empty one has one line. Equal rows of one ``doc_id`` and text get the same result. An
    empty table gives an empty result. Columns of the new names are replaced, others of any name are kept.

    Runs jobs, and keeps suffixes and runs in the shared folder.
    """
    names = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    copies = write_table(later_copies(documents, min_lines=min_lines, min_words=min_words), "line-runs")
    run = F.struct("pos", (F.col("pos") + F.col("lines") - 1).alias("end"))
    removed = copies.groupBy("owner", "copy").agg(F.collect_set(run).alias("runs"))
    places = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["pos"], r["end"]))))
    removed = removed.select("owner", "copy", places.alias("gone"))
    # A document is a struct of its own, so that no name of a column meets one of these.
    keyed = documents.select(F.struct(*names).alias("row"), *[c.alias(name) for name, c in _owner().items()])
    joined = join_splittable(keyed, removed, ["owner", "copy"], "left")
    text, gone = F.col("row.text"), F.col("gone")
    rebuilt = F.when(gone.isNull(), text).otherwise(_without(text, gone))
    lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    less = F.when(gone.isNull(), 0).otherwise(F.size(gone))
    return joined.select(
        *[rebuilt.alias("text") if name == "text" else F.col("row")[name].alias(name) for name in names],
        lines.cast("long").alias("n_lines"),
        less.cast("long").alias("n_removed"),
    )
