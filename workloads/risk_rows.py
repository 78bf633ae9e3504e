"""Risk rows derived from ``orders``, in SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The identifier comes of the whole customer key, one in three rows is of the hot ID0; type, class and
# region do not follow from each other, nor the displayed metric name from the internal one; some
# values and flags are missing. Every order is a row, so the table grows with the orders.
RISK_CTE = """
WITH base AS (
  SELECT o_orderkey AS k,
    concat('ID', CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS STRING)) AS identifier,
    CASE WHEN o_orderkey % 3 = 0 THEN 'ISIN' ELSE CASE o_custkey % 4 WHEN 0 THEN 'ISIN' WHEN 1 THEN 'CUSIP'
      WHEN 2 THEN 'TICKER' ELSE 'SOVEREIGN' END END AS identifier_type,
    CASE CAST(floor(o_custkey / 4) AS BIGINT) % 5 WHEN 0 THEN 'EQUITY' WHEN 1 THEN 'FIXED_INCOME'
      WHEN 2 THEN 'MULTI_ASSET' ELSE 'SOVEREIGN' END AS asset_class,
    CASE CAST(floor(o_custkey / 20) AS BIGINT) % 10 WHEN 0 THEN 'Global' WHEN 1 THEN 'Europe'
      WHEN 2 THEN 'Asia Pacific' ELSE 'North America' END AS region,
    CASE o_orderkey % 4 WHEN 0 THEN 'RCP 8.5' WHEN 1 THEN 'RCP 4.5' WHEN 2 THEN 'SSP2-4.5' ELSE 'SSP1-2.6' END AS scenario_name,
    CASE CAST(floor(o_orderkey / 4) AS BIGINT) % 3 WHEN 0 THEN '2030' WHEN 1 THEN '2050' ELSE '2100' END AS scenario_year,
    CASE CAST(floor(o_orderkey / 12) AS BIGINT) % 3 WHEN 0 THEN 'P5' WHEN 1 THEN 'P50' ELSE 'P95' END AS scenario_percentile,
    concat('Metric ', substring(o_orderpriority, 3)) AS metric_name,
    o_orderpriority AS metric_name_internal,
    CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE CAST(floor(o_totalprice / 600) AS BIGINT) / 1e3 END AS metric_value,
    CAST(o_orderdate AS DATE) AS effective_start_date
  FROM orders),
risk AS (
  SELECT *, effective_start_date AS as_of_date,
    CASE WHEN k % 7 = 0 THEN 'Y' WHEN k % 11 = 0 THEN NULL ELSE 'N' END AS is_proxied,
    concat('v', CAST(k % 5 AS STRING)) AS version,
    CAST(coalesce(lead(effective_start_date) OVER (
      PARTITION BY identifier, identifier_type, scenario_name, scenario_year, scenario_percentile, metric_name_internal
      ORDER BY effective_start_date, k) - INTERVAL '1' DAY, DATE '9999-12-31') AS DATE) AS effective_end_date
  FROM base)
"""

METRIC = "1-URGENT"


def risk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(RISK_CTE.replace("FROM orders", "FROM {orders}") + "SELECT * FROM risk", orders=orders)


def risk_sql(query: str) -> str:
    return f"{RISK_CTE}\n{query}"
