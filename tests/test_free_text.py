"""Large CSV files with line breaks in values, in splits of a few hundred bytes."""

from __future__ import annotations

import csv
import os
import random

import pytest

from tidemill import schemas
from tidemill.catalog import feeds
from tidemill.catalog.tables import LAYOUTS
from tidemill.plans import comments
from tidemill.sources.files import read_csv
from tidemill.sources.free_text import read_free_text, read_records

ROW = schemas.layout(n="long", t="string", u="string")


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(["n", "t", "u"])
        writer.writerows(rows)


def some_rows(seed, rows=250):
    source = random.Random(seed)
    pieces = ["a", "b ", " ", "\n", '"', ",", "é", "\n\n", '""', "漢"]
    made = [(n, "".join(source.choice(pieces) for _ in range(source.choice([0, 3, 40, 200]))), source.choice(["x", "", "y,\nz"])) for n in range(rows)]
    # A value over many splits without a record of its own, one of quotes only, and breaks at its end.
    return [*made, (rows, "line\n" * 800, "long"), (rows + 1, '"' * 1500, "quotes"), (rows + 2, "end\n", "e")]


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_splits_give_what_one_task_reads(spark, folder, small_splits, seed):
    os.makedirs(folder)
    rows = some_rows(seed)
    write(f"{folder}/a.csv", rows)
    write(f"{folder}/b.csv", some_rows(seed + 10, 30))
    found = read_free_text(spark, folder, ROW)
    assert spark.read.text(folder).rdd.getNumPartitions() > 20
    assert tuples(found) == tuples(read_csv(spark, folder, schema=ROW))
    assert ("line\n" * 800,) in tuples(found.where("u = 'long'").select("t"))


def test_records_end_outside_quotes_only(spark, folder, small_splits):
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w", newline="") as file:
        file.write('n,t\r\n1,"a\r\nb"\r\n\r\n2,"c ""x"" d"\r\n   \r\n3,last')
    records = {(row.first, row.value) for row in read_records(spark, folder).collect()}
    assert records == {(True, "n,t"), (False, '1,"a\nb"'), (False, '2,"c ""x"" d"'), (False, "3,last")}
    found = read_free_text(spark, folder, schemas.layout(n="long", t="string"))
    assert tuples(found) == [(1, "a\nb"), (2, 'c "x" d'), (3, "last")]
    assert read_free_text(spark, folder, schemas.layout(n="string", t="string"), header=False).count() == 4


def test_empty_files(spark, folder):
    os.makedirs(folder)
    open(f"{folder}/a.csv", "w").close()
    assert read_free_text(spark, folder, ROW).count() == 0
    write(f"{folder}/b.csv", [])
    assert read_free_text(spark, folder, ROW).count() == 0


def test_a_large_feed_is_cleaned_with_rejects_from_one_reading(spark, folder, small_splits):
    os.makedirs(folder + "-in")
    rows = [*some_rows(5, 60), ("x", "text\nhere", "bad"), (7777, "twice\n", "t"), (7777, "twice\n", "t")]
    write(folder + "-in/a.csv", rows)
    for large in (False, True):
        clean = comments.csv_to_parquet_clean(
            spark, folder + "-in", f"{folder}-{large}", ROW, required=["n"], rejects=f"{folder}-bad-{large}", large_files=large
        )
        assert clean.where("n = 7777").count() == 1 and clean.count() == 64
        bad = spark.read.parquet(f"{folder}-bad-{large}")
        assert tuples(bad) == [(None, "text\nhere", "bad", "n")]
    assert tuples(spark.read.parquet(f"{folder}-True")) == tuples(spark.read.parquet(f"{folder}-False"))


def test_no_task_writes_the_whole_large_feed(spark, folder, small_splits, monkeypatch):
    paths = []

    def path_of(spark, name):
        paths.append(f"{folder}/{name}")
        return paths[-1]

    monkeypatch.setattr(feeds, "new_path", path_of)
    rows = [(n, f'line {n}\n"quoted", and more\n' * 20, "en", None if n % 7 == 0 else "s", n) for n in range(60)]
    given = spark.createDataFrame(rows, LAYOUTS["documents"])
    given.repartition(6).write.parquet(f"{folder}/documents.parquet")
    found = feeds.csv_large_file(spark, folder)
    kept = given.drop("doc_id").dropna()
    assert found.count() == 51 and found.exceptAll(kept).isEmpty()
    files = [name for name in os.listdir(paths[0]) if name.endswith(".csv")]
    assert len(files) > 1
    assert spark.read.text([f"{paths[0]}/{name}" for name in files]).rdd.getNumPartitions() > len(files)
