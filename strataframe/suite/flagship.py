"""Flagship query: mean order price by site and status, from the current
publications of a published-file store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import manifest as M
from ..plans.stack import read_variables, stack_table
from ..session import prepare, write_once
from ..sources.listing import scan_manifest
from .store import SITE_EXPR, store_for

FLAGSHIP_ORACLE = f"""
SELECT {SITE_EXPR} AS siteID, o_orderstatus,
       round(avg(o_totalprice), 4) AS mean_price, cast(count(*) AS bigint) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2
"""


def stacked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    root = store_for(spark, sf_dir)
    manifest = write_once(M.as_of_publication(scan_manifest(spark, root), None), "manifest")
    variables = read_variables(spark, manifest)
    return stack_table(spark, manifest, "ord_orders", variables=variables, package="expanded")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stacked_orders(spark, sf_dir)
    return orders.groupBy("siteID", "o_orderstatus").agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean_price"),
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
    )
