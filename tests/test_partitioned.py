"""Tables in partitions: moved, emptied and untouched partitions, reruns, inserts, interrupted upserts."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.session import fresh_dir
from tallyspark.sources.partitioned import PartitionedTable

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("d", T.DateType()), T.StructField("x", T.IntegerType()),
                       T.StructField("at", T.TimestampNTZType())])


def new_table(spark, grain="month"):
    return PartitionedTable(spark, fresh_dir(spark, "parts"), SCHEMA, "id", "d", grain)


def rows_of(spark, rows, at=1):
    return spark.createDataFrame([(i, d and dt.date.fromisoformat(d), x, dt.datetime(2024, 1, at)) for i, d, x in rows], SCHEMA)


def content(table):
    return sorted((r["id"], str(r["d"]), r["x"]) for r in table.read().collect())


def test_moves_empty_partitions_and_leave_others_alone(spark):
    t = new_table(spark)
    assert t.read().count() == 0 and t.files() == {}
    assert t.upsert(rows_of(spark, [("a", "2024-01-05", 1), ("b", "2024-02-05", 2), ("c", "2024-03-05", 3), ("n", None, 4)])) \
        == ["2024-01", "2024-02", "2024-03", "none"]
    before = t.files()
    # a moves to March and empties January; only rows of the partitions that it leaves and enters are read
    assert t.upsert(rows_of(spark, [("a", "2024-03-06", 9)])) == ["2024-01", "2024-03"]
    after = t.files()
    assert "2024-01" not in after and after["2024-02"] == before["2024-02"] and after["none"] == before["none"]
    assert content(t) == [("a", "2024-03-06", 9), ("b", "2024-02-05", 2), ("c", "2024-03-05", 3), ("n", "None", 4)]
    assert t.upsert(rows_of(spark, [("a", "2024-03-06", 9)])) == [] and t.files() == after
    # a row without a date gets one
    assert t.upsert(rows_of(spark, [("n", "2024-02-01", 4)])) == ["2024-02", "none"] and "none" not in t.files()


def test_same_rows_after_a_change_in_between_are_put_in_again(spark):
    t, first = new_table(spark), [("a", "2024-01-05", 1), ("b", "2024-02-05", 2)]
    t.upsert(rows_of(spark, first))
    t.upsert(rows_of(spark, [("a", "2024-02-07", 5)]))
    assert t.upsert(rows_of(spark, first)) == ["2024-01", "2024-02"]
    assert content(t) == [("a", "2024-01-05", 1), ("b", "2024-02-05", 2)]


def test_insert_adds_files_and_never_replaces(spark):
    t = new_table(spark, "day")
    t.upsert(rows_of(spark, [("a", "2024-01-05", 1), ("b", "2024-01-06", 2)]))
    before = t.files()
    t.insert(rows_of(spark, [("a", "2024-01-06", 7), ("c", "2024-01-06", 3)]))
    assert content(t) == [("a", "2024-01-05", 1), ("b", "2024-01-06", 2), ("c", "2024-01-06", 3)]
    assert t.files()["2024-01-05"] == before["2024-01-05"] and set(before["2024-01-06"]) < set(t.files()["2024-01-06"])
    again = t.files()
    t.insert(rows_of(spark, [("c", "2024-01-06", 3)]))
    assert t.files() == again and t.parts_between(dt.date(2024, 1, 6), dt.date(2024, 2, 1)) == ["2024-01-06"]
    assert t.parts_between(dt.date(2024, 1, 1), dt.date(2024, 1, 6)) == ["2024-01-05"]


def test_interrupted_upsert_is_mended_by_a_rerun(spark):
    """Stopped between its partitions, an upsert leaves a moved key in both; the rerun takes it out of the old one."""
    t = new_table(spark)
    t.upsert(rows_of(spark, [("a", "2024-01-05", 1), ("b", "2024-01-06", 2)]))
    t._write(rows_of(spark, [("a", "2024-02-05", 8)]).withColumn("part", F.lit("2024-02")), "append")
    assert len(content(t)) == 3
    t.upsert(rows_of(spark, [("a", "2024-02-05", 8)]))
    assert content(t) == [("a", "2024-02-05", 8), ("b", "2024-01-06", 2)]


def test_stamp_stays_where_nothing_else_changed(spark):
    t = new_table(spark)
    t.upsert(rows_of(spark, [("a", "2024-01-05", 1), ("b", "2024-01-06", 2), ("c", "2024-02-06", 3)], at=1), "at")
    assert t.upsert(rows_of(spark, [("a", "2024-01-05", 1), ("b", "2024-01-06", 5), ("c", "2024-02-06", 3)], at=2), "at") == ["2024-01"]
    assert {r["id"]: r["at"].day for r in t.read().collect()} == {"a": 1, "b": 2, "c": 1}


def test_random_upserts_equal_a_dictionary(spark):
    rng, t, want = random.Random(7), new_table(spark, "day"), {}
    for turn in range(6):
        batch = {f"k{rng.randrange(12)}": (rng.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]), rng.randrange(3)) for _ in range(rng.choice([1, 8]))}
        rows = rows_of(spark, [(k, d, x) for k, (d, x) in batch.items()])
        if turn == 3:
            t.insert(rows)
            want = batch | want
        else:
            t.upsert(rows)
            want = want | batch
        assert content(t) == sorted((k, str(d), x) for k, (d, x) in want.items())
