"""The index, labels and rolling mean as SQL functions, for ad-hoc queries.

Scalar and table functions with SQL bodies: Catalyst inlines them, so a query that calls them has the plan
of one that spells them out (filters reach the scan, code generation spans them). They are temporary, one
set per session; ``register_functions`` replaces those of an earlier call.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from airindex.functions.index import DOMINANT_ORDER, O3_8H_CEILING, SUB_INDEXES
from airindex.functions.labels import (HAZARD_ABOVE, HEALTH_BANDS, HEALTH_NULL, HEALTH_TOP, LEVEL_LABELS, MIN_RECORDS,
                                       STATUS_INSUFFICIENT, STATUS_MISSING_PM, STATUS_VALID, UNKNOWN_LEVEL)
from airindex.operators.rolling import rolling_rows
from airindex.plans.views import register_views

ROLLED_VIEW = "rolled_readings"


def _text(s: str) -> str:
    return "'" + s.replace("'", "\\'") + "'"


def _segments(x: str, segments) -> str:
    """The CASE of a breakpoint table: the first segment that holds x, else 0."""
    whens = " ".join(f"WHEN {x} >= {lo} AND {x} <= {hi} THEN ({x} - {lo}) * {(i_hi - i_lo) / (hi - lo)!r}D + {i_lo}"
                     for lo, hi, i_lo, i_hi in segments)
    return f"CAST(CASE {whens} ELSE 0.0D END AS INT)"


def scalar_functions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, result type, body)."""
    out = {name.replace("aqi_", "index_"): ("x DOUBLE", "INT", _segments("x", segments)) for name, (_, segments) in SUB_INDEXES.items()}
    levels = " ".join(f"WHEN {value} THEN {_text(label)}" for value, label in LEVEL_LABELS)
    bands = " ".join(f"WHEN x <= {bound} THEN {_text(label)}" for bound, label in HEALTH_BANDS)
    parts = [c for c, _ in DOMINANT_ORDER]
    names = " ".join(f"WHEN greatest({', '.join(parts)}) = {c} THEN {_text(label)}" for c, label in DOMINANT_ORDER[:-1])
    out |= {
        "index_ozone": ("mean_1h DOUBLE, mean_8h DOUBLE", "INT",
                        f"CASE WHEN mean_8h > {O3_8H_CEILING} THEN index_o3_1h(mean_1h) ELSE greatest(index_o3_1h(mean_1h), index_o3_8h(mean_8h)) END"),
        "level_name": ("x INT", "STRING", f"CASE x {levels} ELSE {_text(UNKNOWN_LEVEL)} END"),
        "health_name": ("x INT", "STRING", f"CASE WHEN x IS NULL THEN {_text(HEALTH_NULL)} {bands} ELSE {_text(HEALTH_TOP)} END"),
        "hazardous": ("x INT", "BOOLEAN", f"coalesce(x > {HAZARD_ABOVE}, false)"),
        "day_status": ("records INT, pm25 DOUBLE, pm10 DOUBLE", "STRING",
                       f"CASE WHEN coalesce(records >= {MIN_RECORDS}, false) AND (pm25 IS NOT NULL OR pm10 IS NOT NULL) THEN {_text(STATUS_VALID)} "
                       f"WHEN pm25 IS NULL AND pm10 IS NULL THEN {_text(STATUS_MISSING_PM)} ELSE {_text(STATUS_INSUFFICIENT)} END"),
        "dominant_of": (", ".join(f"{c} INT" for c in parts), "STRING", f"CASE {names} ELSE {_text(DOMINANT_ORDER[-1][1])} END"),
    }
    return out


def register_functions(spark: SparkSession) -> list[str]:
    """Create the scalar functions in this session; their names."""
    made = scalar_functions()
    for name, (parameters, kind, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(made)


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """The temp views and the table functions over them.

    ``rolling_ozone(first, last)``: readings of the days with their 8-row ozone mean;
    ``worst_days(n)``: each location's n days with the highest index.
    """
    rolling_rows(register_views(spark, sf_dir)["readings"], "o3").createOrReplaceTempView(ROLLED_VIEW)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION rolling_ozone(first DATE, last DATE)
        RETURNS TABLE (location_id INT, measured_at TIMESTAMP, o3 DOUBLE, mean_8 DOUBLE, values_8 BIGINT)
        RETURN SELECT location_id, measured_at, o3, rolling_o3, count_o3 FROM {ROLLED_VIEW}
               WHERE measure_date BETWEEN rolling_ozone.first AND rolling_ozone.last""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION worst_days(n INT)
        RETURNS TABLE (location_id INT, measure_date DATE, vn_aqi INT)
        RETURN SELECT location_id, measure_date, vn_aqi FROM (
            SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY vn_aqi DESC NULLS LAST, measure_date) AS place
            FROM fact_air_quality) WHERE place <= worst_days.n""")
