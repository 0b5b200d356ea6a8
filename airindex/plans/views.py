"""Temp views for SQL users: the same tables the DataFrame API works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airindex.operators.star import dim_date_spanning
from airindex.plans.daily import daily_air_index
from airindex.sources.tables import dim_location, reading_days, readings


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register ``readings``, ``fact_air_quality``, ``dim_date`` and ``dim_location``.

    Views are lazy: each SQL query plans the whole chain, so Catalyst still
    prunes columns and pushes filters into the ``events`` scan.
    """
    r = readings(spark, sf_dir)
    views = {
        "readings": r,
        "fact_air_quality": daily_air_index(r),
        "dim_date": dim_date_spanning(reading_days(spark, sf_dir)),
        "dim_location": dim_location(spark, sf_dir),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
