"""Adapters that turn the driver tables into series inputs (FIXTURES.md section 2).

Each adapter reads the whole table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly series with three measures named like the reference's weather variables."""
    ev = table(spark, sf_dir, "events")
    # wall-clock truncation without a session time zone (NTZ in, NTZ out)
    hour = F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"),
                                F.lit(0), F.lit(0))
    return ev.groupBy(hour.alias("time")).agg(
        F.round(F.avg("value"), 4).alias("temperature_2m"),
        F.round(F.avg(F.get_json_object("props", "$.k").cast("double")), 4).alias("relative_humidity_2m"),
        F.count(F.lit(1)).cast("double").alias("wind_speed_10m"),
    )


def _cents_and_count(price: str = "o_totalprice"):
    """Aggregates for an exact average of two-decimal prices: sum of integer cents and rows."""
    return [F.sum(F.round(F.col(price) * 100).cast("long")).alias("__cents"),
            F.count(F.lit(1)).alias("__n")]


def _avg_price_4dp():
    """Average price rounded half-up to 4 decimals in integer arithmetic: with ``S`` = sum of
    cents and ``n`` rows, ``round(S/(100n), 4) = ((200·S + n) div 2n) / 10⁴``. Every engine gets
    the same value, ties included, and ``div`` stays exact for any realistic sum."""
    return F.expr("(__cents * 200 + __n) div (__n * 2)") / F.lit(10000.0)


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keyed daily series (``series`` = order priority) spanning several years."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("time")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y"),
        F.count(F.lit(1)).cast("double").alias("x1"),
        *_cents_and_count(),
    )
    return g.select("series", "time", "y", "x1", _avg_price_4dp().alias("x2"))


def events_raw(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """Long raw series: ``time = ts``, ``y = value``, ``x = props.k``; keyed by event type."""
    ev = table(spark, sf_dir, "events")
    cols = [F.col("ts").alias("time"), F.col("value").alias("y"),
            F.get_json_object("props", "$.k").cast("double").alias("x"), F.col("event_id")]
    if keyed:
        cols.insert(0, F.col("event_type").alias("series"))
    return ev.select(*cols)


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a series with repeated timestamps (dedupe input); tiebreak ``o_orderkey``."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").alias("time"), "o_orderkey",
                    F.col("o_totalprice").alias("y"), F.col("o_custkey"), F.col("o_orderpriority"))


def lineitem_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric line-item columns for Gram matrices, regression and scaling at volume."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
                     "l_returnflag")


def orders_total_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series over all orders (every calendar month of several years is present)."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.col("o_orderdate").alias("time")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y"),
        F.count(F.lit(1)).cast("double").alias("x1"),
        *_cents_and_count(),
    )
    return g.select("time", "y", "x1", _avg_price_4dp().alias("x2"))
