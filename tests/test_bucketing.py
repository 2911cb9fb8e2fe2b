import re

from demandkit.sources.tables import sales_view, write_bucketed_star


def test_bucketed_star_joins_without_shuffle(spark, small_dir):
    write_bucketed_star(spark, small_dir, "dk_bucketed", 4)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = sales_view(spark, small_dir, database="dk_bucketed")
        files = sales_view(spark, small_dir)
        assert view.count() == files.count()
        plan = view.select("date", "qty")._jdf.queryExecution().executedPlan().toString()
        # The lineitem-part sort-merge join reads both bucketed sides
        # directly: no exchange is planned on the part key.
        assert "SortMergeJoin" in plan
        assert not re.search(r"Exchange hashpartitioning\((l_partkey|p_partkey)", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
