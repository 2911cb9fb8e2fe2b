import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandkit.functions.exprs import calendar_columns, parse_date, parse_date_fallback, parse_percent
from demandkit.operators import prepare as prep


def test_calendar_edges(spark):
    days = [dt.date(2024, 12, 30), dt.date(2020, 12, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date date").withColumns(calendar_columns("date"))
    r = {x.date: x for x in df.collect()}
    assert r[dt.date(2024, 12, 30)].day_of_week == 0 and r[dt.date(2024, 12, 30)].week_of_year == 1
    assert r[dt.date(2020, 12, 31)].week_of_year == 53 and r[dt.date(2020, 12, 31)].is_month_end == 1
    assert r[dt.date(2024, 2, 29)].is_month_end == 1 and r[dt.date(2024, 3, 1)].is_month_start == 1
    assert r[dt.date(2024, 3, 1)].quarter == 1 and r[dt.date(2020, 12, 31)].is_weekend == 0


def test_parse_percent_and_dates(spark):
    df = spark.createDataFrame([("15%", "05-03-2024"), ("0%", "2024-03-05")], "m string, d string")
    out = df.select(parse_percent("m").alias("p"), parse_date_fallback("d").alias("d")).collect()
    assert [o.p for o in out] == [0.15, 0.0]
    assert [o.d for o in out] == [dt.date(2024, 3, 5)] * 2


def test_strict_date_parse_fails(spark):
    df = spark.createDataFrame([("2024-03-05",)], "d string")
    with pytest.raises(Exception):
        df.select(parse_date("d")).collect()


def test_label_encode_byte_order_and_inverse(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "B", "a", "b"]], "product string")
    enc = prep.label_encode(df, ["product"])
    got = dict((r.product, r.product_encoded) for r in enc.collect())
    assert got == {"B": 0, "a": 1, "b": 2}
    mapping = prep.encoder_mapping(df, "product")
    back = prep.inverse_encode(enc.select("product_encoded"), mapping.withColumnRenamed("product", "label"), "product")
    assert sorted(r.label for r in back.collect()) == ["B", "a", "b", "b"]


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(float(x), 5.0) for x in [1, 2, 3, 4, 10]], "x double, c double")
    out = prep.standard_scale(df, ["x", "c"]).agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert abs(out[0]) < 1e-12 and abs(out[1] - 1) < 1e-12 and out[2] == 0.0  # constant column -> 0


def test_time_split(spark):
    df = spark.createDataFrame([(dt.date(2000, 6, 30),), (dt.date(2000, 7, 1),)], "date date")
    assert [r.split for r in prep.time_split(df).orderBy("date").collect()] == ["train", "test"]


def test_split_partitions_rows(spark, small_dir):
    from demandkit.plans.context import Tables
    eng = Tables(spark, small_dir).eng_features
    total = eng.count()
    train = eng.where(F.col("split") == "train")
    test = eng.where(F.col("split") == "test")
    assert train.count() + test.count() == total
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
