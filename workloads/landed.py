"""JSON records derived from ``orders``, in SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgate.sources.landing import land
from landgate.workspace import workspace

# Last digit of the key: 0 malformed, 1 wrong type, 2 bad date, 3 nothing nested.
TRADES = """
SELECT o_orderkey AS k, CASE o_orderkey % 10
  WHEN 0 THEN concat('{"record_id":"T', CAST(o_orderkey AS STRING))
  WHEN 1 THEN concat('{"record_id":"T', CAST(o_orderkey AS STRING), '","quantity":"abc"}')
  WHEN 2 THEN concat('{"record_id":"T', CAST(o_orderkey AS STRING), '","trade_date":"2026-13-45","quantity":1.5}')
  WHEN 3 THEN concat('{"record_id":"T', CAST(o_orderkey AS STRING), '","quantity":', CAST(o_totalprice AS STRING), '}')
  ELSE concat('{"record_id":"T', CAST(o_orderkey AS STRING), '","trade_date":"', CAST(CAST(o_orderdate AS DATE) AS STRING),
    '","quantity":', CAST(o_custkey AS STRING), ',"price":', CAST(o_totalprice AS STRING),
    ',"trade_details":{"order":{"order_type":"', o_orderstatus, '"},"market_data":{"volume":', CAST(o_custkey AS STRING), '}}}')
  END AS raw
FROM orders
"""

# Missing accounts, costs that are no numbers, numbers given as numbers, wrong types, nested parts.
BILLS = """
SELECT o_orderkey AS k, concat('{',
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('"billing_account_id":"A', CAST(o_custkey AS STRING), '",') END,
  CASE o_orderkey % 7 WHEN 0 THEN '"cost":"n/a",' WHEN 1 THEN '"cost":".5",' WHEN 2 THEN '"cost":null,'
    WHEN 3 THEN concat('"cost":', CAST(o_custkey AS STRING), ',')
    ELSE concat('"cost":"-', CAST(o_custkey AS STRING), '.25",') END,
  CASE WHEN o_orderkey % 11 = 0 THEN '"currency_conversion_rate":"x",' ELSE '"currency_conversion_rate":1.25,' END,
  CASE WHEN o_orderkey % 3 = 0 THEN '"service":{"id":"S","description":"a } and a ]"},' ELSE '' END,
  CASE WHEN o_orderkey % 4 = 0 THEN '"labels":[{"key":"a","value":"1"},{"key":"b"}],' ELSE '' END,
  '"currency":"USD","project":null}') AS raw
FROM orders
"""

# Records of document files: costs given as numbers, large and small ones too, and by the last digit of
# the key a broken one (0), a scalar (1) or junk behind the document (2).
RECORDS = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN '{"billing_account_id":}'
  WHEN o_orderkey % 10 = 1 THEN 'null'
  ELSE concat('{"cost":', CASE o_orderkey % 6 WHEN 0 THEN concat(CAST(o_custkey + 12345678 AS STRING), '.90')
    WHEN 1 THEN '0.0001' WHEN 2 THEN '"n/a"' ELSE CAST(o_custkey AS STRING) END,
    ',"service":{"id":"S","description":"a } and { and ]"}',
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat(',"billing_account_id":"A', CAST(o_custkey AS STRING), '"') END,
    '}') END AS raw
FROM orders
"""

DOCUMENTS_JUDGED = f"""
WITH texts AS (SELECT k, raw FROM ({RECORDS})
  UNION ALL SELECT 0, 'junk behind it' FROM orders WHERE CAST(floor(o_orderkey / 100) AS BIGINT) % 10 = 2
    GROUP BY floor(o_orderkey / 100)),
judged AS (
  SELECT raw, raw LIKE '{{%' AND json_valid(raw) AS good,
    CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS safe FROM texts)
"""

# Records of which some lack their last brace (10), a quote (20) or have a brace too many (30).
UNCLOSED = """
SELECT o_orderkey AS k, concat('{"cost":"', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 50 = 20 THEN '' ELSE '"' END,
  ',"service":{"id":"S","description":"a } and { and ]"},"labels":[{"key":"a"},{"key":"b"}],"billing_account_id":"A',
  CAST(o_orderkey AS STRING), '"', CASE o_orderkey % 50 WHEN 10 THEN '' WHEN 30 THEN '}}' ELSE '}' END) AS raw
FROM orders
"""

# What DuckDB makes of a trade line: the corrupt ones, and the fields of the good ones.
TRADES_JUDGED = f"""
WITH trades AS ({TRADES}),
judged AS (
  SELECT k, raw, safe, readable AND json_type(safe, '$.quantity') IS DISTINCT FROM 'VARCHAR' AS good
  FROM (SELECT k, raw, json_valid(raw) AS readable,
          CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS safe FROM trades)
)
"""

BILLS_JUDGED = f"""
WITH judged AS (
  SELECT k, raw, json_type(raw, '$.currency_conversion_rate') <> 'VARCHAR' AS good FROM ({BILLS})
)
"""


def _from_orders(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    # A view, because the braces of the JSON would be read as parameters of spark.sql.
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("_orders")
    return spark.sql(sql.replace("FROM orders", "FROM _orders"))


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, TRADES)


def bill_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, BILLS)


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc): arrays of about 100 records over several lines; some have junk behind them."""
    records = _from_orders(spark, sf_dir, RECORDS)
    docs = records.groupBy(F.floor(F.col("k") / 100).alias("d")).agg(
        F.expr(r"concat('[', listagg(raw, ',\n ') WITHIN GROUP (ORDER BY k), ']')").alias("doc")
    )
    junk = F.when(F.col("d") % 10 == 2, F.lit("\njunk behind it")).otherwise(F.lit(""))
    return docs.select(F.concat("doc", junk).alias("doc"))


def unclosed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc): arrays of about 100 records, on lines of their own or all on one line."""
    records = _from_orders(spark, sf_dir, UNCLOSED)
    joined = "concat('[', listagg(raw, '{}') WITHIN GROUP (ORDER BY k), ']')"
    docs = records.groupBy(F.floor(F.col("k") / 100).alias("d")).agg(
        F.expr(joined.format(r",\n  ")).alias("lines"), F.expr(joined.format(",")).alias("dense")
    )
    return docs.select(F.when(F.col("d") % 2 == 0, F.col("lines")).otherwise(F.col("dense")).alias("doc"))


def land_trades(spark: SparkSession, sf_dir: str) -> str:
    """Trade lines written as a landed file set; returns its path."""
    path = workspace(spark, "trades")
    land(trade_lines(spark, sf_dir).select("raw"), path, "text")
    return path
