"""Concentration -> index: piecewise-linear sub-indexes and how they combine.

All functions build plain Column expressions (one CASE chain each), so they
stay inside whole-stage codegen and fold their constant slopes at plan time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Breakpoint tables, one segment per row as
# (concentration low, concentration high, index low, index high), in µg/m³.
PM2_5 = ((0, 25, 0, 50), (25, 50, 51, 100), (50, 80, 101, 150), (80, 150, 151, 200),
         (150, 250, 201, 300), (250, 500, 301, 500))
PM10 = ((0, 50, 0, 50), (50, 150, 51, 100), (150, 250, 101, 150), (250, 350, 151, 200),
        (350, 420, 201, 300), (420, 500, 301, 500))
CO = ((0, 10000, 0, 50), (10000, 30000, 51, 100), (30000, 45000, 101, 150),
      (45000, 60000, 151, 200), (60000, 90000, 201, 300), (90000, 120000, 301, 500))
NO2 = ((0, 100, 0, 50), (100, 200, 51, 100), (200, 700, 101, 150), (700, 1200, 151, 200),
       (1200, 2350, 201, 300), (2350, 3850, 301, 500))
SO2 = ((0, 125, 0, 50), (125, 350, 51, 100), (350, 550, 101, 150), (550, 800, 151, 200),
       (800, 1600, 201, 300), (1600, 2630, 301, 500))
O3_1H = ((0, 160, 0, 50), (160, 200, 51, 100), (200, 300, 101, 150), (300, 400, 151, 200),
         (400, 800, 201, 300), (800, 1200, 301, 500))
O3_8H = ((0, 160, 0, 50), (160, 200, 51, 100), (200, 300, 101, 150), (300, 400, 151, 200))

# The daily input column of each sub-index.
SUB_INDEXES = {
    "aqi_pm25": ("avg_pm2_5", PM2_5),
    "aqi_pm10": ("avg_pm10", PM10),
    "aqi_co": ("max_1h_co", CO),
    "aqi_no2": ("max_1h_no2", NO2),
    "aqi_so2": ("max_1h_so2", SO2),
    "aqi_o3_1h": ("max_1h_o3", O3_1H),
    "aqi_o3_8h": ("max_8h_o3", O3_8H),
}

# The 8-hour ozone mean above which the 1-hour index is used alone.
O3_8H_CEILING = 400

# Dominant pollutant names, in tie-break order.
DOMINANT_ORDER = (("aqi_pm25", "PM2.5"), ("aqi_pm10", "PM10"), ("aqi_co", "CO"),
                  ("aqi_no2", "NO2"), ("aqi_so2", "SO2"), ("aqi_o3", "Ozone"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment_value(x: Column, lo: float, hi: float, i_lo: float, i_hi: float) -> Column:
    """Linear interpolation inside one segment: slope * (x - lo) + i_lo."""
    return (x - lo) * ((i_hi - i_lo) / (hi - lo)) + i_lo


def piecewise_index(x: Column | str, segments: Sequence[tuple], off_scale: str = "zero",
                    null_to_zero: bool = True) -> Column:
    """Index of ``x`` on a breakpoint table, truncated to an int.

    Segments are tried in order and the first containing ``x`` wins, so a value
    on a shared boundary takes the lower segment's top index. Values outside
    every segment give 0 (``off_scale="zero"``) or, above the top, the top index
    (``off_scale="clamp"``). NULL gives 0 unless ``null_to_zero`` is False.
    """
    if off_scale not in ("zero", "clamp"):
        raise ValueError(f"off_scale must be 'zero' or 'clamp', not {off_scale!r}")
    x = _col(x)
    chain = None
    for lo, hi, i_lo, i_hi in segments:
        cond = (x >= lo) & (x <= hi)
        value = segment_value(x, lo, hi, i_lo, i_hi)
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    if off_scale == "clamp":
        top_hi, top_index = segments[-1][1], segments[-1][3]
        chain = chain.when(x > F.lit(top_hi), F.lit(float(top_index)))
    chain = chain.otherwise(F.lit(0.0))
    if not null_to_zero:
        chain = F.when(x.isNull(), F.lit(None).cast("double")).otherwise(chain)
    return chain.cast("int")


def ozone_index(i_1h: Column | str, i_8h: Column | str, mean_8h: Column | str) -> Column:
    """Above the 8-hour ceiling only the 1-hour index counts; else the larger of both.

    A NULL 8-hour mean falls through to the larger-of-both branch.
    """
    i_1h, i_8h, mean_8h = _col(i_1h), _col(i_8h), _col(mean_8h)
    return F.when(mean_8h > F.lit(O3_8H_CEILING), i_1h).otherwise(F.greatest(i_1h, i_8h))


def overall_index(*parts: Column | str) -> Column:
    """Overall index: the largest sub-index (NULL parts are ignored)."""
    return F.greatest(*[_col(p) for p in parts]).cast("int")


def dominant_pollutant(index: Column | str, raw_index: Column | str,
                       pairs: Sequence[tuple[str, str]] = DOMINANT_ORDER) -> Column:
    """Name of the first sub-index equal to the overall index; NULL when ``index`` is NULL."""
    index, raw_index = _col(index), _col(raw_index)
    chain = F.when(index.isNull(), F.lit(None).cast("string"))
    for column, name in pairs[:-1]:
        chain = chain.when(raw_index == _col(column), F.lit(name))
    return chain.otherwise(F.lit(pairs[-1][1]))


def breakpoint_table(spark, tables: dict[str, Sequence[tuple]] | None = None):
    """Breakpoints as a small DataFrame (sub_index, seg, lo, hi, i_lo, i_hi, slope).

    Segment 0 is closed, the others are open below (a shared bound belongs to the lower
    segment), so that every value is in one segment at most.
    """
    tables = tables or {name: segs for name, (_, segs) in SUB_INDEXES.items()}
    rows = [(name, seg, float(lo), float(hi), int(i_lo), int(i_hi), (i_hi - i_lo) / (hi - lo))
            for name, segs in tables.items() for seg, (lo, hi, i_lo, i_hi) in enumerate(segs)]
    return spark.createDataFrame(
        rows, "sub_index string, seg int, lo double, hi double, i_lo int, i_hi int, slope double")
