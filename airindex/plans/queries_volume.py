"""The star join and top-n report at volume, on the TPC-H-like tables.

The air-quality fact has one row per location-day; these queries run the same
join and ranking operators over ``lineitem`` (about 600,000 rows at sf0.1).
Revenue is exact: prices and discounts carry 2 decimals, so each line's
``price * (1 - discount)`` is an integer count of 10^-4 units.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airindex.operators.series import top_n
from airindex.operators.star import star_join
from airindex.plans.catalog import register
from airindex.sources.tables import load

TOP_LINES = 3


def _order_side(spark, sf_dir):
    """Orders with their customer's nation: the small joins, before any line is touched."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    customer = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return star_join(orders, [(star_join(customer, [(nation, "c_nationkey")]), "o_custkey")])


def _lineitem(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")


def _net_units():
    price = F.round(F.col("l_extendedprice") * 100.0).cast("long")
    keep = F.round((F.lit(1.0) - F.col("l_discount")) * 100.0).cast("long")
    return price * keep


_LINES_SQL = """WITH lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_discount, o.o_orderdate, n.n_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_NET_SQL = ("cast(round(l_extendedprice * 100.0) AS bigint) * "
            "cast(round((1.0 - l_discount) * 100.0) AS bigint)")


@register("star_join_volume", _LINES_SQL + f"""
SELECT n_name, cast(year(o_orderdate) AS int) AS order_year,
       cast(sum({_NET_SQL}) AS double) / 10000.0::double AS revenue,
       count(DISTINCT l_orderkey) AS orders, count(*) AS lines
FROM lines GROUP BY 1, 2""")
def q_star_join_volume(spark, sf_dir):
    """Revenue, orders and lines per nation and year: lineitem joined to orders,
    customer and nation."""
    # Lines are reduced to one row per order before the join; the join then meets on the same
    # key, so lineitem is shuffled once.
    per_order = _lineitem(spark, sf_dir).groupBy("l_orderkey").agg(
        F.sum(_net_units()).alias("net"), F.count(F.lit(1)).alias("n_lines"))
    joined = star_join(per_order, [(_order_side(spark, sf_dir), "l_orderkey")])
    return joined.groupBy("n_name", F.year("o_orderdate").alias("order_year")).agg(
        (F.sum("net").cast("double") / 10000.0).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("n_lines").alias("lines"))


@register("top_n_volume", _LINES_SQL + f"""
SELECT n_name, l_orderkey, l_linenumber, l_extendedprice, cast(rn AS int) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY l_extendedprice DESC,
                               l_orderkey, l_linenumber) AS rn FROM lines)
WHERE rn <= {TOP_LINES}""")
def q_top_n_volume(spark, sf_dir):
    """The most expensive lines of each nation (ties broken by order and line number)."""
    lines = star_join(_lineitem(spark, sf_dir), [(_order_side(spark, sf_dir), "l_orderkey")])
    return top_n(lines, ["n_name"], [F.col("l_extendedprice").desc(), "l_orderkey",
                                     "l_linenumber"], TOP_LINES, rank_col="rn").select(
        "n_name", "l_orderkey", "l_linenumber", "l_extendedprice", "rn")
