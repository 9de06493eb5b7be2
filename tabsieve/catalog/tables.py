"""Loading the test tables, and the dirtied view most diagnostics need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Valid in both engines; the tables themselves hold no missing value.
DIRTY_ORDERS = """
  o_orderkey, o_custkey, o_orderpriority, o_orderdate,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'na'
       WHEN o_orderkey % 17 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS sparse_col,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS is_even,
  CASE WHEN o_orderkey % 4 = 0 THEN 'bajo' WHEN o_orderkey % 4 = 1 THEN 'n/d'
       ELSE CAST(o_orderkey % 9 AS STRING) END AS floor_txt,
  CAST(NULL AS DOUBLE) AS empty_col,
  'const' AS const_col
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT {DIRTY_ORDERS} FROM {{orders}}", orders=table(spark, sf_dir, "orders"))


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round floating point results, which differ in the last bits between engines."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
