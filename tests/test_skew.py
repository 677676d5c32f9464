from pyspark.sql import functions as F

from tallyspark.operators.skew import count_copies, expand_copies


def test_copies_round_trip_in_chunks(spark):
    df = spark.createDataFrame([("a",)] * 23 + [("b",)] * 2 + [("c",)], "x string")
    counted = count_copies(df, ["x"])
    assert {r["x"]: r["_copies"] for r in counted.collect()} == {"a": 23, "b": 2, "c": 1}
    back = expand_copies(counted, ["x"], per_chunk=5)
    assert sorted(r["x"] for r in back.collect()) == sorted(r["x"] for r in df.collect())


def test_chunks_of_a_hot_group_fall_to_several_tasks(spark):
    hot = spark.createDataFrame([("a", 1000)], "x string, _copies bigint")
    made = expand_copies(hot, ["x"], per_chunk=10).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in made) == 1000 and len(made) > 1
