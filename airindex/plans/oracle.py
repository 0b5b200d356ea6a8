"""DuckDB twins of the registered queries (the driver's correctness oracle).

Each string is one SELECT over the pre-registered views (``events``, ``nation``,
``orders`` ...). Engine differences are handled here once:

* Spark rounds doubles HALF_UP on their decimal form; DuckDB's ``round`` works
  on the binary value. ``rnd`` goes through a decimal to match.
* Spark's ``cast(double as int)`` truncates; DuckDB's rounds. ``trunc_int``.
* Means are exact on both sides: ``mean_sql`` and ``window_mean_sql`` are the
  integer-unit twins of ``functions.exact`` (DuckDB divides decimals into
  doubles, so the division is done on integers).
* ``count_if`` is a HUGEINT in DuckDB; the twins cast it to BIGINT.
"""

from __future__ import annotations

# Fixed values, stated here again and not imported: the twins must not follow a mistake of the
# library. (concentration low, concentration high, index low, index high) per segment.
SUB_INDEXES = {
    "aqi_pm25": ("avg_pm2_5", ((0, 25, 0, 50), (25, 50, 51, 100), (50, 80, 101, 150), (80, 150, 151, 200),
                               (150, 250, 201, 300), (250, 500, 301, 500))),
    "aqi_pm10": ("avg_pm10", ((0, 50, 0, 50), (50, 150, 51, 100), (150, 250, 101, 150), (250, 350, 151, 200),
                              (350, 420, 201, 300), (420, 500, 301, 500))),
    "aqi_co": ("max_1h_co", ((0, 10000, 0, 50), (10000, 30000, 51, 100), (30000, 45000, 101, 150),
                             (45000, 60000, 151, 200), (60000, 90000, 201, 300), (90000, 120000, 301, 500))),
    "aqi_no2": ("max_1h_no2", ((0, 100, 0, 50), (100, 200, 51, 100), (200, 700, 101, 150), (700, 1200, 151, 200),
                               (1200, 2350, 201, 300), (2350, 3850, 301, 500))),
    "aqi_so2": ("max_1h_so2", ((0, 125, 0, 50), (125, 350, 51, 100), (350, 550, 101, 150), (550, 800, 151, 200),
                               (800, 1600, 201, 300), (1600, 2630, 301, 500))),
    "aqi_o3_1h": ("max_1h_o3", ((0, 160, 0, 50), (160, 200, 51, 100), (200, 300, 101, 150), (300, 400, 151, 200),
                                (400, 800, 201, 300), (800, 1200, 301, 500))),
    "aqi_o3_8h": ("max_8h_o3", ((0, 160, 0, 50), (160, 200, 51, 100), (200, 300, 101, 150), (300, 400, 151, 200))),
}
O3_8H_CEILING = 400
DOMINANT_ORDER = (("aqi_pm25", "PM2.5"), ("aqi_pm10", "PM10"), ("aqi_co", "CO"), ("aqi_no2", "NO2"),
                  ("aqi_so2", "SO2"), ("aqi_o3", "Ozone"))
LEVEL_LABELS = ((1, "Good"), (2, "Fair"), (3, "Moderate"), (4, "Poor"), (5, "Very Poor"))
UNKNOWN_LEVEL = "Unknown"
HEALTH_BANDS = ((50, "Good"), (100, "Moderate"), (150, "Poor"), (200, "Unhealthy"), (300, "Very Unhealthy"))
HEALTH_TOP, HEALTH_NULL, HAZARD_ABOVE = "Hazardous", "N/A", 200
MIN_RECORDS, MIN_8H_VALUES = 18, 6
STATUS_VALID, STATUS_MISSING_PM, STATUS_INSUFFICIENT = "Valid", "Missing PM Data", "Insufficient Data (<75%)"
# The binding of the test tables.
USERS_PER_LOCATION, LEVEL_STEP, DECIMALS, VALUE_DECIMALS, CO_PER_VALUE = 20, 25.0, 6, 2, 400


def rnd(x: str, d: int = 2) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), {d}) as double)"


def units_sql(x: str, scale: int = 6) -> str:
    return f"cast(round({x} * {float(10 ** scale)}) AS bigint)"


def half_up_div_sql(num: str, den: str) -> str:
    a, b = f"(abs({num}) * 2 + {den})", f"({den} * 2)"
    qq = f"cast(({a} - {a} % {b}) / {b} AS bigint)"
    return f"(CASE WHEN {num} < 0 THEN -{qq} ELSE {qq} END)"


def mean_sql(x: str, digits: int = 2, scale: int = 6) -> str:
    """Twin of ``mean_half_up``: exact HALF_UP mean."""
    total, n = f"sum({units_sql(x, scale)})", f"count({x})"
    k = half_up_div_sql(f"({total} * {10 ** digits})", f"({n} * {10 ** scale})")
    return f"(CASE WHEN {n} > 0 THEN cast({k} AS double) / {float(10 ** digits)}::double END)"


def window_mean_sql(x: str, w: str = "w", scale: int = 6) -> str:
    """Twin of ``exact_window_mean``."""
    n = f"count({x}) OVER {w}"
    return (f"(CASE WHEN {n} > 0 THEN cast(sum({units_sql(x, scale)}) OVER {w} AS double) / "
            f"(cast({n} AS double) * {float(10 ** scale)}::double) END)")


def trunc_int(x: str) -> str:
    return f"cast(trunc({x}) as int)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def piecewise_sql(x: str, segments, off_scale: str = "zero") -> str:
    parts = [f"WHEN {x} >= {lo} AND {x} <= {hi} THEN "
             f"(({i_hi} - {i_lo}) / ({hi} - {lo})) * ({x} - {lo}) + {i_lo}"
             for lo, hi, i_lo, i_hi in segments]
    if off_scale == "clamp":
        parts.append(f"WHEN {x} > {segments[-1][1]} THEN {float(segments[-1][3])}")
    return trunc_int("CASE " + " ".join(parts) + " ELSE 0.0 END")


def level_label_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} = {v} THEN {q(label)}" for v, label in LEVEL_LABELS)
    return f"CASE {whens} ELSE {q(UNKNOWN_LEVEL)} END"


def health_label_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {b} THEN {q(label)}" for b, label in HEALTH_BANDS)
    return f"CASE WHEN {x} IS NULL THEN {q(HEALTH_NULL)} {whens} ELSE {q(HEALTH_TOP)} END"


def hazardous_sql(x: str) -> str:
    return f"coalesce({x} > {HAZARD_ABOVE}, false)"


def valid_sql(count: str = "record_count", pms=("avg_pm2_5", "avg_pm10")) -> str:
    any_pm = " OR ".join(f"{p} IS NOT NULL" for p in pms)
    return f"(coalesce({count} >= {MIN_RECORDS}, false) AND ({any_pm}))"


def status_sql(count: str = "record_count", pms=("avg_pm2_5", "avg_pm10")) -> str:
    all_missing = " AND ".join(f"{p} IS NULL" for p in pms)
    return (f"CASE WHEN {valid_sql(count, pms)} THEN {q(STATUS_VALID)} "
            f"WHEN {all_missing} THEN {q(STATUS_MISSING_PM)} ELSE {q(STATUS_INSUFFICIENT)} END")


def dominant_sql(index: str = "vn_aqi", raw: str = "vn_aqi_raw") -> str:
    whens = " ".join(f"WHEN {raw} = {c} THEN {q(n)}" for c, n in DOMINANT_ORDER[:-1])
    return f"CASE WHEN {index} IS NULL THEN NULL {whens} ELSE {q(DOMINANT_ORDER[-1][1])} END"


def date_id_sql(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as int)"


def _only(kind: str) -> str:
    return f"CASE WHEN event_type = {q(kind)} THEN value END"


HOURLY = f"""hourly AS (
  SELECT cast(user_id // {USERS_PER_LOCATION} AS int) AS location_id,
         date_trunc('hour', ts) AS measured_at,
         {mean_sql('value', DECIMALS, VALUE_DECIMALS)} AS _mean,
         {mean_sql(_only('view'), DECIMALS, VALUE_DECIMALS)} AS pm2_5,
         {mean_sql(_only('signup'), DECIMALS, VALUE_DECIMALS)} AS pm10,
         max({_only('error')}) AS o3,
         max({_only('click')}) * 5 AS no2,
         max({_only('purchase')}) * 3 AS so2,
         max(value) * {CO_PER_VALUE} AS co,
         min(value) AS no,
         min({_only('purchase')}) AS nh3
  FROM events GROUP BY 1, 2)"""

DIM_LOCATION = f"""dim_location AS (
  SELECT i.location_id, n_name || ' ' || i.location_id AS city_name,
         cast(100.0 + i.location_id AS double) AS lon, cast(10.0 + i.location_id AS double) AS lat
  FROM (SELECT DISTINCT cast(user_id // {USERS_PER_LOCATION} AS int) AS location_id FROM events) i
  JOIN nation ON n_nationkey = i.location_id % 25)"""

READINGS = DIM_LOCATION + ",\n" + HOURLY + f""",
readings0 AS (
  SELECT location_id, cast(100.0 + location_id AS double) AS lon,
         cast(10.0 + location_id AS double) AS lat, measured_at,
         cast(least(5, 1 + floor(_mean / {LEVEL_STEP})) AS int) AS aqi_level,
         co, no, no2, o3, so2, pm2_5, pm10, nh3
  FROM hourly),
readings AS (
  SELECT *, {level_label_sql('aqi_level')} AS aqi_label,
         cast(measured_at AS date) AS measure_date,
         strftime(measured_at, '%Y') AS measure_year,
         strftime(measured_at, '%m') AS measure_month,
         strftime(measured_at, '%d') AS measure_day
  FROM readings0)"""

READING_COLS = ("location_id, lon, lat, measured_at, aqi_level, co, no, no2, o3, so2, pm2_5, "
                "pm10, nh3, aqi_label, measure_date, measure_year, measure_month, measure_day")

def rolled_ctes(src: str = "readings") -> str:
    """CTEs ``buckets`` and ``rolled`` (8-row ozone window per location-day with halo)."""
    return f"""buckets AS (
  SELECT *, measure_date AS bucket FROM {src}
  UNION ALL
  SELECT *, measure_date + 1 AS bucket FROM {src}),
rolled AS (
  SELECT * FROM (
    SELECT *, {window_mean_sql('o3')} AS rolling_o3, count(o3) OVER w AS count_o3
    FROM buckets
    WINDOW w AS (PARTITION BY location_id, bucket ORDER BY measured_at
                 ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
  WHERE measure_date = bucket)"""


ROLLED = READINGS + ",\n" + rolled_ctes()


def rollup_sql(src: str, keys: str = "location_id, measure_date", with_8h: bool = True) -> str:
    cols = [f"{mean_sql('aqi_level')} AS avg_aqi", "max(aqi_level) AS max_aqi",
            "min(aqi_level) AS min_aqi", f"{mean_sql('pm2_5')} AS avg_pm2_5",
            "max(pm2_5) AS max_pm2_5", f"{mean_sql('pm10')} AS avg_pm10",
            "max(pm10) AS max_pm10", f"{rnd('max(co)')} AS max_1h_co",
            f"{rnd('max(no2)')} AS max_1h_no2", f"{rnd('max(so2)')} AS max_1h_so2",
            f"{rnd('max(o3)')} AS max_1h_o3"]
    if with_8h:
        cols.append(f"{rnd(f'max(CASE WHEN count_o3 >= {MIN_8H_VALUES} THEN rolling_o3 END)')}"
                    " AS max_8h_o3")
    cols += [f"{mean_sql('co')} AS avg_co", f"{mean_sql('no2')} AS avg_no2",
             f"{mean_sql('so2')} AS avg_so2", f"{mean_sql('o3')} AS avg_o3",
             f"{mean_sql('no')} AS avg_no", f"{mean_sql('nh3')} AS avg_nh3",
             "cast(count(*) AS int) AS record_count"]
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY {keys}"


def sub_index_cols(off_scale: str = "zero") -> str:
    return ", ".join(f"{piecewise_sql(src, segs, off_scale)} AS {name}"
                     for name, (src, segs) in SUB_INDEXES.items())


FACT_COLS = ("date_id, location_id, vn_aqi, dominant_pollutant, health_implication, "
             "is_hazardous, data_quality_status, avg_aqi, max_aqi, min_aqi, avg_pm2_5, "
             "max_pm2_5, avg_pm10, max_pm10, max_1h_co, max_1h_no2, max_1h_so2, max_1h_o3, "
             "max_8h_o3, avg_co, avg_no2, avg_so2, avg_o3, avg_no, avg_nh3, record_count, "
             "measure_date")

def fact_ctes() -> str:
    """CTEs from ``rolled`` to ``fact`` (the daily index fact); ``fact_all`` keeps sub-indexes."""
    return f"""daily AS ({rollup_sql('rolled')}),
idx AS (SELECT *, {sub_index_cols()} FROM daily),
ozone AS (SELECT *, CASE WHEN max_8h_o3 > {O3_8H_CEILING} THEN aqi_o3_1h
                         ELSE greatest(aqi_o3_1h, aqi_o3_8h) END AS aqi_o3 FROM idx),
raw AS (SELECT *, cast(greatest(aqi_pm25, aqi_pm10, aqi_co, aqi_no2, aqi_so2, aqi_o3) AS int)
                  AS vn_aqi_raw FROM ozone),
gated AS (SELECT *, {status_sql()} AS data_quality_status,
                 CASE WHEN {valid_sql()} THEN vn_aqi_raw END AS vn_aqi FROM raw),
fact_all AS (SELECT *, {health_label_sql('vn_aqi')} AS health_implication,
                    {hazardous_sql('vn_aqi')} AS is_hazardous,
                    {dominant_sql()} AS dominant_pollutant,
                    {date_id_sql('measure_date')} AS date_id FROM gated),
fact AS (SELECT {FACT_COLS} FROM fact_all)"""


FACT = ROLLED + ",\n" + fact_ctes()


def with_fact(select: str) -> str:
    """A query over the ``fact`` CTE (and ``readings``)."""
    return f"WITH {FACT}\n{select}"


def with_readings(select: str) -> str:
    return f"WITH {READINGS}\n{select}"


def with_rolled(select: str) -> str:
    return f"WITH {ROLLED}\n{select}"
