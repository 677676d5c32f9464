from pyspark.sql import functions as F

from tallyspark.functions import bucket_label, guarded_duration_sec, row_json, title_case


def test_title_case_breaks_words_at_any_non_alphanumeric(spark):
    df = spark.createDataFrame([("mary-jane o'brien MD 3rd",), ("tunde  bello 12",), (None,)], "n string")
    got = [r[0] for r in df.select(title_case("n")).collect()]
    assert got == ["Mary-Jane O'Brien Md 3rd", "Tunde  Bello 12", None]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0,), (59,), (60,), (299,), (300,)], "d int")
    got = [r[0] for r in df.select(bucket_label(F.col("d"))).collect()]
    assert got == ["short", "short", "medium", "medium", "long"]


def test_guarded_duration_bad_clocks(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", "2024-01-01 10:00:00"), ("2024-01-01 10:00:00", "2024-01-01 09:59:00"),
         ("2024-01-01 10:00:00", None), ("2024-01-01 10:00:00", "2024-01-01 10:02:05")], "s string, e string")
    got = [r[0] for r in df.select(guarded_duration_sec(F.col("s").cast("timestamp"),
                                                        F.col("e").cast("timestamp"))).collect()]
    assert got == [0, 0, 0, 125]


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(row_json(["x", "y"])).first()[0] == '{"x":"a","y":null}'
