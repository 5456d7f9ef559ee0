"""Tables over several loads: winners by place, touched buckets, landing, lost writers."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemill.operators.winners import latest_rows, lost_places, on_files
from tidemill.plans import comments
from tidemill.sinks import buckets, landing, versions


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_of_a_scan(spark, folder):
    rows = [("a", 1, "x"), ("a", 2, "y"), (None, 5, "n"), (None, 4, "m"), ("b", None, "z"), ("b", None, "z"), ("c", 1, "only")]
    spark.createDataFrame(rows, "k string, n int, t string").repartition(3).write.parquet(folder)
    scan = spark.read.parquet(folder)
    assert tuples(latest_rows(scan, ["k"], "n")) == [("a", 2, "y"), ("b", None, "z"), ("c", 1, "only"), (None, 5, "n")]
    kept = latest_rows(scan.where("t <> 'y'"), ["k"], "n")
    assert tuples(kept.where("k = 'a'")) == [("a", 1, "x")] and kept.columns == ["k", "n", "t"]
    # Without an order the columns decide, whatever the files.
    assert tuples(latest_rows(scan, ["k"])) == [("a", 2, "y"), ("b", None, "z"), ("c", 1, "only"), (None, 5, "n")]
    again = on_files(spark.createDataFrame(rows[::-1], "k string, n int, t string").repartition(5))
    assert tuples(latest_rows(scan, ["k"])) == tuples(latest_rows(again, ["k"]))
    assert latest_rows(scan.where("false"), ["k"], "n").count() == 0


def test_rows_that_share_a_place_are_written_first(spark, folder):
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int").write.parquet(folder)
    scan = spark.read.parquet(folder)
    assert on_files(scan.where("n > 0").withColumn("x", F.lit(1))).inputFiles() == scan.inputFiles()
    twice = [scan.crossJoin(spark.range(2)).drop("id"), scan.union(scan), scan.select("k", "n", F.explode(F.array(F.lit(1), F.lit(1)))).drop("col")]
    for rows in twice:
        assert tuples(latest_rows(on_files(rows), ["k"])) == [("a", 1), ("b", 2)]


def test_winners_are_chosen_without_sorting_rows(spark, folder):
    spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS n", "repeat('wide', 100) AS t").write.parquet(folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scan = spark.read.parquet(folder)
        lost = lost_places(scan, ["k"], "n")
        assert lost.count() == 1000
        ties = lost_places(scan.withColumn("n", F.lit(1)), ["k"], "n")
        plan = plan_of(ties)
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan and ties.count() == 1000
        found = latest_rows(scan, ["k"], "n")
        assert "SortAggregate" not in plan_of(found)
        # Rows of the frequent key meet by place, which is different for each of them.
        assert found.where("k = 7").select("n").first().n == 2997 and found.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_lost_rows_leave_the_table_unshuffled(spark, folder):
    spark.range(1000).selectExpr("id % 998 AS k", "id AS n").write.parquet(folder)
    found = latest_rows(spark.read.parquet(folder), ["k"], "n")
    assert found.count() == 998
    assert "Exchange hashpartitioning" not in plan_of(found) and "BroadcastHashJoin" in plan_of(found)


def test_only_touched_buckets_are_rewritten(spark, folder):
    first = spark.range(1000).selectExpr("id AS k", "'first' AS t")
    buckets.append_delta(first, folder, ["k"], 1, buckets=16)
    buckets.compact_buckets(spark, folder, ["k"])
    before = buckets.parts_in_force(spark, folder)
    files = set(glob.glob(f"{folder}/data/**/*.parquet", recursive=True))
    for load, key in ((2, 5), (3, 700)):
        buckets.append_delta(spark.createDataFrame([(key, f"load {load}"), (key, f"load {load}")], "k long, t string"), folder, ["k"], load)
    buckets.append_delta(spark.createDataFrame([(5, "late")], "k long, t string"), folder, ["k"], 0)
    read = tuples(buckets.read_buckets(spark, folder, ["k"]))
    assert buckets.compact_buckets(spark, folder, ["k"]) == 6
    after = buckets.parts_in_force(spark, folder)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) <= 2 and len(before) == 16
    assert files <= set(glob.glob(f"{folder}/data/**/*.parquet", recursive=True))
    assert read == tuples(buckets.read_buckets(spark, folder, ["k"]))
    assert dict(read)[5] == "load 2" and dict(read)[700] == "load 3" and len(read) == 1000
    assert buckets.compact_buckets(spark, folder, ["k"]) == 6
    with pytest.raises(ValueError, match="compacted"):
        buckets.append_delta(first, folder, ["k"], 1)


def test_a_repeated_load_replaces_itself(spark, folder):
    schema = "k string, n int"
    buckets.append_delta(spark.createDataFrame([("a", 1), ("b", 1)], schema), folder, ["k"], 1, buckets=4)
    buckets.append_delta(spark.createDataFrame([("a", 9)], schema), folder, ["k"], 2)
    buckets.append_delta(spark.createDataFrame([("b", 2)], schema), folder, ["k"], 2)
    assert tuples(buckets.read_buckets(spark, folder, ["k"], with_load=True)) == [("a", 1, 1), ("b", 2, 2)]
    buckets.append_delta(spark.createDataFrame([], schema), folder, ["k"], 3)
    assert tuples(buckets.read_buckets(spark, folder, ["k"])) == [("a", 1), ("b", 2)]


def test_a_lost_writer_leaves_the_old_version(spark, folder, monkeypatch):
    schema = "k string, n int"
    buckets.append_delta(spark.createDataFrame([("a", 1)], schema), folder, ["k"], 1, buckets=2)
    # Lost after its data, and lost while its version was written.
    spark.createDataFrame([("a", 5)], schema).write.parquet(f"{folder}/data/delta-lost/key_bucket=0")
    spark.createDataFrame([("x",)], "path string").write.parquet(f"{folder}/versions/v000000000002")
    (marker,) = glob.glob(f"{folder}/versions/v000000000002/_SUCCESS")
    __import__("os").unlink(marker)
    assert tuples(buckets.read_buckets(spark, folder, ["k"])) == [("a", 1)]
    assert buckets.append_delta(spark.createDataFrame([("b", 2)], schema), folder, ["k"], 2) == 2
    assert tuples(buckets.read_buckets(spark, folder, ["k"])) == [("a", 1), ("b", 2)]
    with pytest.raises(PySparkException):
        versions.publish_version(spark.createDataFrame([("x",)], "path string"), folder, 2)
    assert versions.expire(spark, folder, "path string", keep=1) == ["delta-lost"]
    assert versions.known_versions(spark, folder) == [2]
    assert tuples(buckets.read_buckets(spark, folder, ["k"])) == [("a", 1), ("b", 2)]


def test_reading_what_was_never_loaded(spark, folder):
    with pytest.raises(ValueError, match="no complete version"):
        buckets.read_buckets(spark, folder, ["k"])
    with pytest.raises(ValueError, match="no complete version"):
        landing.read_landed(spark, folder)


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


SCHEMA = "comment_id string, post_id string, created_time timestamp, post_created_time timestamp, t string"


def comment(n, t, post_day=0):
    return (f"c{n:04}", "p", day(n // 100), day(post_day), t)


def test_a_second_load_leaves_one_row_per_key(spark, folder):
    rows = [comment(n, "old", n % 7) for n in range(1000)] + [(None, "p", day(0), day(0), "x"), ("d", None, day(0), None, "x")]
    assert comments.land_comments(spark.createDataFrame(rows, SCHEMA), folder).count() == 2
    before = landing.files_in_force(spark, folder)
    assert len(before) == 10
    # Two old keys of one day, one of them twice, and a new one; an old key moves to another day.
    load = [comment(105, "new", 20), comment(105, "new", 20), comment(150, "new"), comment(2000, "new")]
    load.append(("c0310", "p", day(5), day(1), "moved"))
    second = spark.createDataFrame(load, SCHEMA)
    named = landing.candidate_files(spark, folder, second.withColumn("created_time_day", F.to_date("created_time")), ["comment_id"])
    assert {path.split("created_time_day=")[1][:10] for path in named} >= {"2024-01-02", "2024-01-04"} and len(named) < 6
    comments.land_comments(second, folder)
    after = landing.files_in_force(spark, folder)
    assert len(set(before) - set(after)) == 2
    table = landing.read_landed(spark, folder)
    assert table.count() == 1001 and table.select("comment_id").distinct().count() == 1001
    assert tuples(table.where("t <> 'old'").select("comment_id", "t", "created_time_day")) == [
        ("c0105", "new", day(1).date()), ("c0150", "new", day(1).date()), ("c0310", "moved", day(5).date()), ("c2000", "new", day(20).date())
    ]


def test_a_filter_on_the_second_day_opens_only_named_files(spark, folder):
    rows = [comment(n, "old", n // 200) for n in range(1000)]
    comments.land_comments(spark.createDataFrame(rows, SCHEMA), folder)
    comments.land_comments(spark.createDataFrame([comment(10, "new", 3)], SCHEMA), folder)
    found = landing.read_second_days(spark, folder, "post_created_time", "2024-01-04", "2024-01-04")
    opened = {row.f.split(folder + "/")[1] for row in found.select(F.input_file_name().alias("f")).distinct().collect()}
    assert opened == set(landing.files_of_days(spark, folder, "2024-01-04", "2024-01-04"))
    assert len(found.inputFiles()) == 3 < len(landing.files_in_force(spark, folder))
    assert found.count() == 201 and found.where("t = 'new'").count() == 1
    assert landing.read_second_days(spark, folder, "post_created_time", "2030-01-01", "2030-01-02").count() == 0


def test_text_times_are_landed_and_indexed(spark, folder):
    schema = "comment_id string, post_id string, created_time string, post_created_time string"
    rows = [("a", "p", "2024-01-01 10:00:00", "2024-01-03 00:00:00"), ("b", "p", "no time", None)]
    comments.land_comments(spark.createDataFrame(rows, schema), folder)
    assert landing.read_landed(spark, folder).count() == 2
    found = landing.read_second_days(spark, folder, "post_created_time_parsed", "2024-01-03", "2024-01-03")
    assert [row.comment_id for row in found.collect()] == ["a"]
