"""`dirty_orders`: the orders table as text with defects put in by key."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sift.sources.rulefile import GateConfig
from sift.sources.scratch import scratch_path

COLUMNS = ("order_id", "customer_id", "status", "amount", "order_date", "priority")

RULES = {
    "duplicate_check": [],
    "required_cols": ["order_id", "customer_id", "amount", "order_date"],
    "null_check": ["customer_id", "status"],
    "dateformatchecks": ["order_date"],
    "cols_datatype": [
        {
            "order_id": "bigint",
            "customer_id": "bigint",
            "amount": "decimal(12,2)",
            "order_date": "date",
        }
    ],
    "no_negative_value": ["amount"],
}


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")

    def every(n: int) -> Column:
        return key % n == 0

    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    copies = 1 + every(23).cast("int") + every(46).cast("int")
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .select(
            key.cast("string").alias("order_id"),
            F.when(~every(17), F.col("o_custkey").cast("string")).alias("customer_id"),
            F.when(~every(34), F.col("o_orderstatus")).alias("status"),
            F.when(every(41), "-0.50")
            .when(every(13), F.concat(F.lit("-"), amount))
            .otherwise(amount)
            .alias("amount"),
            F.when(every(19), "not-a-date")
            .when(every(29), F.lit(None))
            .when(every(31), "31/12/1997")
            .otherwise(F.col("o_orderdate").cast("date").cast("string"))
            .alias("order_date"),
            F.col("o_orderpriority").alias("priority"),
            F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
        )
        .drop("copy")
    )


# The same table in SQL, by union.
DIRTY_SQL = """
base AS (
  SELECT o_orderkey AS k,
    CAST(o_orderkey AS varchar) AS order_id,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS varchar) END AS customer_id,
    CASE WHEN o_orderkey % 34 = 0 THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 41 = 0 THEN '-0.50'
         WHEN o_orderkey % 13 = 0 THEN '-' || CAST(CAST(o_totalprice AS decimal(12,2)) AS varchar)
         ELSE CAST(CAST(o_totalprice AS decimal(12,2)) AS varchar) END AS amount,
    CASE WHEN o_orderkey % 19 = 0 THEN 'not-a-date'
         WHEN o_orderkey % 29 = 0 THEN NULL
         WHEN o_orderkey % 31 = 0 THEN '31/12/1997'
         ELSE CAST(CAST(o_orderdate AS date) AS varchar) END AS order_date,
    o_orderpriority AS priority
  FROM orders),
d AS (
  SELECT order_id, customer_id, status, amount, order_date, priority FROM base
  UNION ALL
  SELECT order_id, customer_id, status, amount, order_date, priority FROM base WHERE k % 23 = 0
  UNION ALL
  SELECT order_id, customer_id, status, amount, order_date, priority FROM base WHERE k % 46 = 0)
"""


def rule_document(root: str = "") -> dict:
    """The rule file for `dirty_orders`, its four prefixes below `root`."""
    folders = {
        "sourcefile": "landing",
        "targetfile": "target",
        "pendingfile": "pending",
        "auditfile": "audit",
    }
    return {key: f"{root}/{name}/orders/" for key, name in folders.items()} | RULES


def orders_config(root: str = "") -> GateConfig:
    return GateConfig.from_mapping(rule_document(root))


def write_rule_file(spark: SparkSession, document: dict, path: str) -> None:
    """Store a rule file where every executor can read it."""
    text = json.dumps(document, indent=1)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def fresh_root(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)
