import os

import pytest
from pyspark.sql import functions as F

from demandkit.sources import files
from demandkit.sources.tables import orphan_sales, sales_view


def _raw_csv(spark, small_dir, path):
    sales = sales_view(spark, small_dir).limit(50)
    inv = {v: k for k, v in files.RAW_COLUMNS.items()}
    cols = [c for c in files.RAW_COLUMNS.values() if c in sales.columns]
    sales.select(*[F.col(c).alias(inv[c]) for c in cols]).coalesce(1).write.option("header", True).csv(path)
    return [inv[c] for c in cols]


def test_read_sales_csv_declared_schema(spark, small_dir, tmp_path):
    p = str(tmp_path / "raw")
    headers = _raw_csv(spark, small_dir, p)
    df = files.read_sales_csv(spark, p, headers)
    assert df.count() == 50
    assert df.where(F.col("date").isNull()).count() == 0
    assert dict(df.dtypes)["unit_price"] == "double"


def test_resolve_source_falls_back(spark, small_dir):
    def missing():
        return spark.read.parquet("/nonexistent/table.parquet")

    def local():
        return spark.read.parquet(f"{small_dir}/nation.parquet")

    assert files.resolve_source(missing, local).count() == 25


def test_prepared_folders_prune_by_date_and_split(spark, small_dir, tmp_path):
    import datetime as dt

    from demandkit.operators.prepare import time_split
    sales = time_split(sales_view(spark, small_dir, columns=["date", "qty"]).where("date BETWEEN '2000-06-20' AND '2000-07-12'"))
    path = str(tmp_path / "prep")
    files.write_prepared(sales, path, salts=2)
    assert sorted(os.listdir(path))[-2:] == ["split=test", "split=train"]
    days = os.listdir(f"{path}/split=train")
    assert "date=2000-06-30" in days and "date=2000-07-01" not in days
    assert max(len([f for f in os.listdir(f"{path}/split=train/{d}") if f.endswith(".parquet")]) for d in days) <= 3
    key = ["date", "qty", "split"]
    assert sorted(map(tuple, files.read_prepared(spark, path).select(*key).collect())) == sorted(map(tuple, sales.select(*key).collect()))
    some = files.read_prepared(spark, path, "test").where(F.col("date") >= F.lit(dt.date(2000, 7, 10)))
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert "date#" in filters.split("]")[0] + filters.split("PushedFilters")[0] and "split" in filters.split("PushedFilters")[0]
    assert len(some.inputFiles()) < len(files.read_prepared(spark, path).inputFiles()) or some.count() > 0


def test_document_in_chunks_round_trip(spark, small_dir, tmp_path):
    import datetime as dt
    nation = spark.read.parquet(f"{small_dir}/nation.parquet").select("n_nationkey", "n_name")
    mixed = spark.createDataFrame([(i, None if i % 3 else f"tücke \"{i}\"", i / 7, dt.date(2024, 1, 1 + i)) for i in range(9)],
                                  "k int, s string, d double, day date")
    path = str(tmp_path / "doc")
    manifest = files.write_document({"n": (nation, ["n_nationkey"]), "m": (mixed, ["k"]), "none": (mixed.limit(0), ["k"])}, path, rows=4)
    assert {r.section: (r.chunks, r.rows) for r in manifest.collect()} == {"n": (7, 25), "m": (3, 9), "none": (0, 0)}
    back = files.read_document(spark, path)
    assert sorted(map(tuple, back["n"].collect())) == sorted(map(tuple, nation.collect()))
    assert sorted(map(tuple, back["m"].collect())) == sorted(map(tuple, mixed.collect())) and back["m"].schema == mixed.schema
    assert back["none"].collect() == []
    chunks = files.document_chunks({"n": (nation, ["n_nationkey"])}, 10).orderBy("chunk").collect()
    assert [r.n_rows for r in chunks] == [10, 10, 5] and '"n_nationkey":10' in chunks[1].body[:40]


def test_rejects_are_counted_kept_aside_or_fatal(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Date,Product,Size\n01-02-2024,Boots,9\n02-02-2024,Flats,not-a-size\n99-99-2024,Heels,7\n,Clogs,8\n2024-02-05,Mules,6\n")
    headers = ["Date", "Product", "Size"]
    df = files.read_sales_csv(spark, str(p), headers).cache()
    assert {r.reject: r["count"] for r in files.reject_counts(df).collect()} == {"malformed line": 1, "no date": 1, "unparsable date": 1}
    good, rejects = files.split_rejects(df, str(tmp_path / "rejects"))
    assert sorted(r["product"] for r in good.collect()) == ["Boots", "Mules"] and files.REJECT not in good.columns
    lines = {r.reject: r.line for r in rejects.collect()}
    assert "not-a-size" in lines["malformed line"] and "Heels" in lines["unparsable date"]
    assert files.read_sales_csv(spark, str(p), headers, bad_rows="drop").count() == 2
    with pytest.raises(files.BadRows, match="1 x malformed line, 1 x no date, 1 x unparsable date"):
        files.read_sales_csv(spark, str(p), headers, bad_rows="fail")
    clean = tmp_path / "good.csv"
    clean.write_text("Date,Product,Size\n01-02-2024,Boots,9\n")
    assert files.read_sales_csv(spark, str(clean), headers, bad_rows="fail").count() == 1


def test_results_json_is_read_whole(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"n": [{"a": 1},\n {"a": 2}]}')
    assert len(files.read_results_json(spark, str(tmp_path / "r.json")).first()["n"]) == 2


def test_malformed_csv_lines_are_kept_aside(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Date,Product,Size\n01-02-2024,Boots,9\n02-02-2024,Flats,not-a-size\n")
    df = files.read_sales_csv(spark, str(p), ["Date", "Product", "Size"]).cache()
    assert df.count() == 2
    bad = df.where(F.col(files.CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["product"] == "Flats" and bad[0]["size"] is None


def test_insight_and_enriched_sinks_round_trip(spark, small_dir, tmp_path):
    nation = spark.read.parquet(f"{small_dir}/nation.parquet").select("n_nationkey", "n_name")
    files.write_insights({"a": nation, "b": nation.limit(3)}, str(tmp_path / "insights"))
    assert spark.read.json(str(tmp_path / "insights" / "a")).count() == 25
    assert spark.read.json(str(tmp_path / "insights" / "b")).count() == 3
    files.overwrite_enriched(nation, str(tmp_path / "enriched"))
    files.overwrite_enriched(nation.limit(5), str(tmp_path / "enriched"))
    assert spark.read.parquet(str(tmp_path / "enriched")).count() == 5


def test_bugs_in_the_primary_source_are_raised(spark):
    with pytest.raises(ZeroDivisionError):
        files.resolve_source(lambda: 1 / 0, lambda: spark.range(1))


def test_pruned_views_equal_the_full_one(spark, small_dir):
    full = sales_view(spark, small_dir)
    for cols in (["date", "qty"], ["product", "qty"], ["dealer", "date"], ["dealer_location", "stock"]):
        pruned = sales_view(spark, small_dir, columns=cols)
        assert sorted(pruned.columns) == sorted(cols)
        assert pruned.select(*cols).exceptAll(full.select(*cols)).isEmpty()
        assert pruned.count() == full.count()
    assert set(orphan_sales(spark, small_dir).first()) == {0}


def test_large_dimensions_are_not_broadcast(spark, small_dir, monkeypatch):
    from demandkit.sources import tables
    columns = ("date", "product", "brand", "dealer", "qty")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    few = tables.sales_view(spark, small_dir, columns=columns)
    assert "BroadcastExchange" in plan(few)
    app = spark.sparkContext.applicationId
    assert tables._ROWS[app, small_dir, "part"] == spark.read.parquet(f"{small_dir}/part.parquet").count()
    for name in ("part", "supplier"):
        monkeypatch.setitem(tables._ROWS, (app, small_dir, name), tables.BROADCAST_ROW_LIMIT + 1)
    many = tables.sales_view(spark, small_dir, columns=columns)
    assert "BroadcastExchange" not in plan(many) and plan(many).count("SortMergeJoin") == 2
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
