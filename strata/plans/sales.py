"""Sales questions over a star-schema analogue of a flat sales table.

Sales row = one ``lineitem`` line.  Columns of the flat table map to:
Date = o_orderdate, Year/Month(name)/Day from it, Country = customer nation
name, State = c_mktsegment, Order_Quantity = l_quantity, Revenue =
l_extendedprice (orders: o_totalprice for ranking, where the key is unique),
Unit_Price = p_retailprice, Unit_Cost = l_extendedprice / l_quantity,
Product_Category = p_type.

Plan shape: a question that filters orders, customers or countries filters
them first, so that ``lineitem`` is joined once, on the order key, with what is
left, and only its order key is read.  A question over all lines aggregates
before it joins: lines are counted per order on the map side, the per-order
counts join ``orders`` and are summed per customer, then per nation.  Every
aggregation has a partial (map-side) step, so a hot key is combined before the
shuffle.  Dimensions are attached only when a question reads them; the star
schema is referentially complete (every line has its order, customer, nation
and part), which the oracle SQL checks by using the full join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions.dates import date_from_parts, month_name
from strata.operators import stats
from strata.sources.writers import peek, row_count
from strata.plans.tables import Tables

# Parameters of the analogue questions.
COUNTRY = "NATION_6"          # single-country questions
COUNTRY_PAIR = ("NATION_6", "NATION_12")
AGE_OVER = 17                 # quantity threshold standing in for an age filter
EXACT_QUANTITY = 17
YEAR = 1998
MONTH = "May"
MONTHS = ("May", "June", "July")
REVENUE_BONUS = 50
TAX_RATE = 1.072
TOP_N = 5
HIST_BINS = 30
LIKE_PREDICATE = "o_orderpriority LIKE '1-%' AND o_orderstatus NOT LIKE 'P%'"


def _nation(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name")


def lines_per_order(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


def lines_per_customer(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    o = (orders if orders is not None else t.orders).select("o_orderkey", "o_custkey")
    return (lines_per_order(t).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey").agg(F.sum("n").alias("n")))


def lines_per_nation(t: Tables) -> DataFrame:
    per_cust = lines_per_customer(t)
    c = t.customer.select("c_custkey", "c_nationkey")
    per_nation = (per_cust.join(c, F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey").agg(F.sum("n").alias("n")))
    return (per_nation.join(_nation(t), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_name", F.col("n").cast("bigint").alias("n")))


def _customers(t: Tables, country=None) -> DataFrame:
    """Customers with their nation, those of the nations that ``country`` admits."""
    nat = _nation(t) if country is None else _nation(t).filter(country)
    return (t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey")))


def _orders_of(t: Tables, customers: DataFrame) -> DataFrame:
    """Orders with their customers' columns."""
    return t.orders.select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _lines_of(t: Tables, orders: DataFrame, *columns: str, line_filter=None) -> DataFrame:
    """Lines (``columns`` beside the order key) of some orders: the one join with lineitem."""
    lines = t.lineitem if line_filter is None else t.lineitem.filter(line_filter)
    return lines.select("l_orderkey", *columns).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


# --------------------------------------------------------------------------- questions

def value_counts_priority(spark: SparkSession, sf: str) -> DataFrame:
    return stats.value_counts(Tables(spark, sf).orders, "o_orderpriority")


def sales_per_year(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    per_order = lines_per_order(t).join(
        t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")),
        F.col("l_orderkey") == F.col("o_orderkey"))
    return stats.value_counts(per_order, "year", weight="n")


def country_share(spark: SparkSession, sf: str) -> DataFrame:
    return stats.with_share(lines_per_nation(Tables(spark, sf)))


def top_country(spark: SparkSession, sf: str) -> DataFrame:
    counts = lines_per_nation(Tables(spark, sf))
    return stats.top_n(counts, 1, [F.col("n").desc(), F.col("n_name").asc()])


def category_share(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    per_type = (per_part.join(t.part.select("p_partkey", "p_type"),
                              F.col("l_partkey") == F.col("p_partkey"))
                .groupBy("p_type").agg(F.sum("n").cast("bigint").alias("n")))
    return stats.with_share(per_type)


def state_counts_in_country(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    orders = _orders_of(t, _customers(t, F.col("n_name") == COUNTRY))
    return _lines_of(t, orders).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


def filter_and(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    orders = _orders_of(t, _customers(t, F.col("n_name") == COUNTRY))
    columns = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    rows = _lines_of(t, orders, *columns, line_filter=F.col("l_quantity") > AGE_OVER)
    return rows.select("l_orderkey", *columns, "n_name")


def filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return (t.lineitem.filter(F.col("l_quantity") == EXACT_QUANTITY)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))


def filter_or_count(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    a, b = COUNTRY_PAIR
    orders = _orders_of(t, _customers(t, (F.col("n_name") == a) | (F.col("n_name") == b)))
    return row_count(_lines_of(t, orders.select("o_orderkey")))


def _orders_in_months(t: Tables, year: int, months) -> DataFrame:
    d = F.col("o_orderdate")
    # The year test is a date range, so it reaches the parquet scan as a
    # pushed filter; the month-name test runs on what survives it.
    return (t.orders.filter((d >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                            & (d < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
            .filter(month_name(d).isin(*months)))


def month_count(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return row_count(_lines_of(t, _orders_in_months(t, YEAR, [MONTH]).select("o_orderkey")))


def filter_in_count(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return row_count(_lines_of(t, _orders_in_months(t, YEAR, MONTHS).select("o_orderkey")))


def _revenue_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey",
                           (F.col("o_totalprice") + F.lit(REVENUE_BONUS)).alias("revenue"))


def top_n_revenue(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return stats.top_n(_revenue_orders(t), TOP_N,
                       [F.col("revenue").desc(), F.col("o_orderkey").asc()])


def max_revenue_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stats.rows_at_max(_revenue_orders(Tables(spark, sf)), "revenue")


def add_constant(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             (F.col("l_extendedprice") + F.lit(REVENUE_BONUS)).alias("revenue"))


def conditional_tax(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    orders = _orders_of(t, _customers(t)).select("o_orderkey", "n_name")
    rows = (_lines_of(t, orders, "l_linenumber", "l_partkey")
            .join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey")))
    price = F.col("p_retailprice")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "n_name",
                       F.when(F.col("n_name") == COUNTRY, price * F.lit(TAX_RATE))
                        .otherwise(price).alias("unit_price"))


def _dated_orders(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).alias("year"), month_name(d).alias("month"),
                           F.dayofmonth(d).alias("day"))


def build_date_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    o = _dated_orders(Tables(spark, sf))
    return o.select("o_orderkey", "year", "month", "day",
                    date_from_parts("year", "month", "day").alias("calculated_date"))


def daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    o = _dated_orders(t).select("o_orderkey",
                                date_from_parts("year", "month", "day").alias("calculated_date"))
    per_order = lines_per_order(t).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return stats.value_counts(per_order, "calculated_date", weight="n")


def column_mean(spark: SparkSession, sf: str) -> DataFrame:
    return stats.mean(Tables(spark, sf).lineitem, "l_quantity", "mean_quantity")


def distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sorted_distinct(Tables(spark, sf).customer, "c_mktsegment")


def histogram_30(spark: SparkSession, sf: str) -> DataFrame:
    return stats.histogram(Tables(spark, sf).lineitem, "l_quantity", HIST_BINS)


def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.box_stats(Tables(spark, sf).lineitem, "l_quantity")


def box_stats_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity box per customer country.  Lines are first collapsed to
    (order, quantity) counts, then (customer, quantity), then (nation,
    quantity): each join sees pre-aggregated pairs."""
    t = Tables(spark, sf)
    pairs = t.lineitem.groupBy("l_orderkey", "l_quantity").agg(F.count(F.lit(1)).alias("w"))
    pairs = (pairs.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("o_custkey", "l_quantity").agg(F.sum("w").alias("w")))
    pairs = (pairs.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy("c_nationkey", "l_quantity").agg(F.sum("w").alias("w")))
    pairs = pairs.join(_nation(t), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "l_quantity", "w")
    return stats.box_stats(pairs, "l_quantity", by=["n_name"], weight="w")


def density_grid(spark: SparkSession, sf: str) -> DataFrame:
    d = stats.density_grid(Tables(spark, sf).lineitem, "l_quantity")
    return d.select("i", F.round("x", 8).alias("x"), F.round("density", 8).alias("density"))


def box_stats_price_by_country(spark: SparkSession, sf: str) -> DataFrame:
    """Price box per customer country: a continuous measure, nearly one value a line."""
    t = Tables(spark, sf)
    orders = _orders_of(t, _customers(t)).select("o_orderkey", "n_name")
    rows = _lines_of(t, orders, "l_extendedprice").select("n_name", "l_extendedprice")
    out = stats.box_stats(rows, "l_extendedprice", by=["n_name"])
    return out.select("n_name", "n", *[F.round(c, 6).alias(c) for c in out.columns[2:-1]], "n_outliers")


def xy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    rows = t.lineitem.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumn("unit_cost", F.col("l_extendedprice") / F.col("l_quantity"))
    return stats.xy_pairs(rows, "unit_cost", F.col("p_retailprice").alias("unit_price"), keep=["l_orderkey", "l_linenumber"])


def top_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The parts on the most lines: exact counts, though hardly any part's lines are counted one by one."""
    return stats.top_values(Tables(spark, sf).lineitem, "l_partkey", TOP_N)


def like_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """A predicate given as SQL text, with a prefix pattern."""
    t = Tables(spark, sf)
    return t.orders.where(LIKE_PREDICATE).select("o_orderkey", "o_orderpriority", "o_orderstatus")


def peek_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows by order key."""
    t = Tables(spark, sf)
    return peek(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), TOP_N, [F.col("o_orderkey")])


QUERIES = {
    "value_counts_priority": value_counts_priority,
    "sales_per_year": sales_per_year,
    "country_share": country_share,
    "top_country": top_country,
    "category_share": category_share,
    "state_counts_in_country": state_counts_in_country,
    "filter_and": filter_and,
    "filter_eq": filter_eq,
    "filter_or_count": filter_or_count,
    "month_count": month_count,
    "filter_in_count": filter_in_count,
    "top_n_revenue": top_n_revenue,
    "max_revenue_rows": max_revenue_rows,
    "add_constant": add_constant,
    "conditional_tax": conditional_tax,
    "build_date_from_parts": build_date_from_parts,
    "daily_counts": daily_counts,
    "column_mean": column_mean,
    "distinct_sorted": distinct_sorted,
    "histogram_30": histogram_30,
    "box_stats": box_stats,
    "box_stats_by_group": box_stats_by_group,
    "box_stats_price_by_country": box_stats_price_by_country,
    "density_grid": density_grid,
    "xy_pairs": xy_pairs,
    "like_prefix": like_prefix,
    "top_parts": top_parts,
    "peek_orders": peek_orders,
}


# --------------------------------------------------------------------------- oracle SQL
# The flat sales table, defined by the full star join.
_SALES = """
WITH sales AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice,
         o.o_orderdate, n.n_name, c.c_mktsegment, p.p_retailprice, p.p_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_C, (_A, _B) = COUNTRY, COUNTRY_PAIR
_MONTHS = ", ".join(f"'{m}'" for m in MONTHS)

ORACLE = {
    "value_counts_priority": """
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""",
    "sales_per_year": _SALES + """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM sales GROUP BY 1""",
    "country_share": _SALES + """,
c AS (SELECT n_name, count(*) AS n FROM sales GROUP BY n_name)
SELECT n_name, n, n / (SELECT CAST(sum(n) AS DOUBLE) FROM c) AS share FROM c""",
    "top_country": _SALES + """
SELECT n_name, count(*) AS n FROM sales GROUP BY n_name ORDER BY n DESC, n_name LIMIT 1""",
    "category_share": _SALES + """,
c AS (SELECT p_type, count(*) AS n FROM sales GROUP BY p_type)
SELECT p_type, n, n / (SELECT CAST(sum(n) AS DOUBLE) FROM c) AS share FROM c""",
    "state_counts_in_country": _SALES + f"""
SELECT c_mktsegment, count(*) AS n FROM sales WHERE n_name = '{_C}' GROUP BY c_mktsegment""",
    "filter_and": _SALES + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, n_name
FROM sales WHERE l_quantity > {AGE_OVER} AND n_name = '{_C}'""",
    "filter_eq": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_quantity = {EXACT_QUANTITY}""",
    "filter_or_count": _SALES + f"""
SELECT count(*) AS n FROM sales WHERE n_name = '{_A}' OR n_name = '{_B}'""",
    "month_count": _SALES + f"""
SELECT count(*) AS n FROM sales WHERE year(o_orderdate) = {YEAR} AND monthname(o_orderdate) = '{MONTH}'""",
    "filter_in_count": _SALES + f"""
SELECT count(*) AS n FROM sales WHERE year(o_orderdate) = {YEAR} AND monthname(o_orderdate) IN ({_MONTHS})""",
    "top_n_revenue": f"""
SELECT o_orderkey, o_custkey, o_totalprice + {REVENUE_BONUS} AS revenue FROM orders
ORDER BY revenue DESC, o_orderkey LIMIT {TOP_N}""",
    "max_revenue_rows": f"""
SELECT o_orderkey, o_custkey, o_totalprice + {REVENUE_BONUS} AS revenue FROM orders
WHERE o_totalprice + {REVENUE_BONUS} = (SELECT max(o_totalprice + {REVENUE_BONUS}) FROM orders)""",
    "add_constant": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice + {REVENUE_BONUS} AS revenue FROM lineitem""",
    "conditional_tax": _SALES + f"""
SELECT l_orderkey, l_linenumber, l_partkey, n_name,
       CASE WHEN n_name = '{_C}' THEN p_retailprice * {TAX_RATE} ELSE p_retailprice END AS unit_price
FROM sales""",
    "build_date_from_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, monthname(o_orderdate) AS month,
       CAST(dayofmonth(o_orderdate) AS INTEGER) AS day,
       CAST(strptime(CAST(year(o_orderdate) AS VARCHAR) || '-' || monthname(o_orderdate) || '-'
            || CAST(dayofmonth(o_orderdate) AS VARCHAR), '%Y-%B-%d') AS DATE) AS calculated_date
FROM orders""",
    "daily_counts": _SALES + """
SELECT CAST(o_orderdate AS DATE) AS calculated_date, count(*) AS n FROM sales GROUP BY 1""",
    "column_mean": """
SELECT CAST(round(CAST(sum(CAST(l_quantity AS DECIMAL(20,4))) AS DECIMAL(38,4))
       / CAST(count(l_quantity) AS DECIMAL(38,0)), 6) AS DOUBLE) AS mean_quantity FROM lineitem""",
    "distinct_sorted": """
SELECT DISTINCT c_mktsegment FROM customer ORDER BY c_mktsegment""",
    "histogram_30": f"""
WITH s AS (SELECT CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range({HIST_BINS})),
c AS (SELECT CAST(least(floor((CAST(l_quantity AS DOUBLE) - lo) / (hi - lo) * {HIST_BINS}), {HIST_BINS - 1}) AS INTEGER) AS bin,
             count(*) AS n FROM lineitem, s WHERE l_quantity IS NOT NULL GROUP BY 1)
SELECT b.bin, lo + CAST(b.bin AS DOUBLE) * ((hi - lo) / {HIST_BINS}) AS bin_lo,
       lo + (CAST(b.bin AS DOUBLE) + 1) * ((hi - lo) / {HIST_BINS}) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin""",
    "box_stats": """
WITH v AS (SELECT CAST(l_quantity AS DOUBLE) AS v FROM lineitem WHERE l_quantity IS NOT NULL),
q AS (SELECT count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM v)
SELECT q.n, min(v) AS min, q1, median, q3, max(v) AS max, q3 - q1 AS iqr,
       min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_lo,
       max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_hi,
       count(CASE WHEN NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM v, q GROUP BY q.n, q1, median, q3""",
    "box_stats_by_group": _SALES + """,
v AS (SELECT n_name, CAST(l_quantity AS DOUBLE) AS v FROM sales WHERE l_quantity IS NOT NULL),
q AS (SELECT n_name, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM v GROUP BY n_name)
SELECT q.n_name, q.n, min(v) AS min, q1, median, q3, max(v) AS max, q3 - q1 AS iqr,
       min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_lo,
       max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_hi,
       count(CASE WHEN NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM v JOIN q ON v.n_name = q.n_name GROUP BY q.n_name, q.n, q1, median, q3""",
    "box_stats_price_by_country": _SALES + """,
v AS (SELECT n_name, CAST(l_extendedprice AS DOUBLE) AS v FROM sales WHERE l_extendedprice IS NOT NULL),
q AS (SELECT n_name, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM v GROUP BY n_name)
SELECT q.n_name, q.n, round(min(v), 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(max(v), 6) AS max, round(q3 - q1, 6) AS iqr,
       round(min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_lo,
       round(max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_hi,
       count(CASE WHEN NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM v JOIN q ON v.n_name = q.n_name GROUP BY q.n_name, q.n, q1, median, q3""",
    "top_parts": f"""
SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT {TOP_N}""",
    "like_prefix": f"SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE {LIKE_PREDICATE}",
    "peek_orders": f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT {TOP_N}",
    "density_grid": """
WITH s AS (SELECT count(l_quantity) AS n, stddev_samp(l_quantity) AS sd,
                  CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem),
p AS (SELECT n, sd * pow(n, -0.2) AS bw, lo - (hi - lo) / 2.0 AS glo, hi + (hi - lo) / 2.0 AS ghi FROM s),
g AS (SELECT CAST(range AS INTEGER) AS i, glo + CAST(range AS DOUBLE) * ((ghi - glo) / 999) AS x FROM range(1000), p),
c AS (SELECT CAST(l_quantity AS DOUBLE) AS v, count(*) AS c FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1)
SELECT g.i, round(g.x, 8) AS x,
       round(sum(c.c * exp(-0.5 * ((g.x - c.v) / p.bw) * ((g.x - c.v) / p.bw)))
             * (1.0 / (p.n * p.bw * sqrt(2 * pi()))), 8) AS density
FROM g CROSS JOIN c CROSS JOIN p GROUP BY g.i, g.x, p.n, p.bw""",
    "xy_pairs": """
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_cost, p_retailprice AS unit_price
FROM lineitem JOIN part ON l_partkey = p_partkey""",
}
