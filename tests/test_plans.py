"""Plan shapes that matter at scale, and the driver contract."""

import os

from pyspark.sql import functions as F

from airindex.plans.daily import daily_air_index, day_range_buffer
from airindex.schemas import READING
from airindex.sinks.files import write_partitioned
from airindex.sources.tables import readings
from tests.conftest import SF001, SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _final(df) -> dict:
    from tools.plan_report import summarize
    df.collect()
    return summarize(_explain(df))


def test_flagship_plan_shape(spark):
    s = _final(daily_air_index(readings(spark, SF01)))
    # one exchange for the hourly aggregate, one for the location-month window; the rollup
    # reuses the window's partitioning; never a single-partition exchange
    assert s["exchanges"] == 2 and not s["single"]
    assert s["kinds"] == "hashpartitioning"


def test_upsert_merge_reuses_partitioning(spark):
    import __spark_entry__ as E
    s = _final(E.queries()["upsert_readings"](spark, SF001))
    assert s["exchanges"] <= 2 and s["bnlj"] == 0
    # The fact is partitioned by (location, month bucket); merging it on (location, day)
    # shuffles the daily fact itself (one row per location-day, 24x smaller than the
    # readings), not the readings.
    s = _final(E.queries()["upsert_daily_fact"](spark, SF001))
    assert s["exchanges"] <= 6 and s["bnlj"] == 0


def test_breakpoint_join_is_broadcast(spark):
    import __spark_entry__ as E
    s = _final(E.queries()["index_by_breakpoint_join"](spark, SF001))
    assert s["bhj"] >= 1 and s["bnlj"] == 0 and s["smj"] == 0


def test_partition_filters_on_measure_date(spark, tmp_dir):
    path = os.path.join(tmp_dir, "readings")
    write_partitioned(readings(spark, SF001), path, "measure_date")
    table = spark.read.schema(READING).parquet(path)
    buf = day_range_buffer(table, "2024-01-10", "2024-01-10")
    plan = _explain(buf)
    assert "PartitionFilters" in plan and "measure_date" in plan.split("PartitionFilters")[1]
    assert buf.select("measure_date").distinct().count() <= 2


def test_star_report_broadcasts_dimensions(spark):
    import __spark_entry__ as E
    s = _final(E.queries()["star_report"](spark, SF001))
    # Date and location, and the location dimension's own join to its names.
    assert s["bhj"] == 3 and s["smj"] == 0 and not s["single"]


def test_readings_scan_prunes_columns(spark):
    plan = _explain(readings(spark, SF001).select("location_id", "measured_at", "o3"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in plan


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:2] == ["date_id", "location_id"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    from airindex.plans.catalog import ORACLE, QUERIES
    assert set(QUERIES) <= set(q) and set(QUERIES) - set(ORACLE) == {"forecast_fourier", "forecast_changepoints"}
    assert F is not None


def test_range_read_is_pushed_to_the_scan(spark):
    r = readings(spark, SF01, "2024-01-10", "2024-01-12", lead_days=1)
    plan = _explain(r)
    assert "GreaterThanOrEqual(ts,2024-01-09T00:00)" in plan
    assert "LessThan(ts,2024-01-13T00:00)" in plan
    ranged = daily_air_index(r, "2024-01-10", "2024-01-12")
    full = daily_air_index(readings(spark, SF01)).filter(
        F.col("measure_date").between("2024-01-10", "2024-01-12"))
    assert ranged.count() == full.count() > 0
    assert ranged.exceptAll(full).count() == 0 and full.exceptAll(ranged).count() == 0


def test_volume_queries_shuffle_lineitem_once(spark):
    """With nothing small enough to broadcast, the lines meet one exchange, on the order key."""
    import re

    from airindex.plans.catalog import QUERIES
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for name in ("star_join_volume", "top_n_volume"):
            plan = QUERIES[name](spark, SF01)._jdf.queryExecution().sparkPlan().toString()
            executed = QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
            assert "lineitem" in plan
            on_lines = [x for x in executed.splitlines() if re.search(r"Exchange hashpartitioning\(l_orderkey", x)]
            # One exchange for the lines, one for the orders.
            assert len(on_lines) == 2, executed
    finally:
        spark.conf.set(key, before)


def test_oracle_states_its_own_values():
    import ast
    import inspect

    from airindex.plans import oracle
    tree = ast.parse(inspect.getsource(oracle))
    imports = [n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)]
    assert imports == ["__future__"]
