"""Derived columns that give the clean test tables the dirt and gaps the operators handle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinwork.sources.readers import table

LINE_ORDER = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_FLAGS = ("big", "discounted", "untaxed", "returned", "finished")


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an untyped feed would bring them: words for flags, bad numbers and clocks."""
    bad_date = F.when(F.expr("event_id % 19 = 0"), "not a date").otherwise(
        F.date_format("ts", "MM/dd/yyyy"))
    return table(spark, folder, "events").select(
        "event_id",
        F.expr(
            "case event_id % 8 when 0 then 'Yes' when 1 then 'N' when 2 then 'true' when 3 then '0' "
            "when 4 then 'maybe' when 5 then null when 6 then 'y' else 'FALSE' end"
        ).alias("flag"),
        F.expr("case when event_id % 11 = 0 then 'n/a' else cast(event_id as string) end").alias("whole"),
        F.expr("case when event_id % 7 = 0 then '12.5' else cast(event_id as string) end").alias("mixed"),
        F.expr("case when event_id % 9 = 0 then 'x' else cast(value as string) end").alias("number"),
        bad_date.alias("day"),
        F.expr("case when event_id % 13 = 0 then '25:00:00' else date_format(ts, 'HH:mm:ss') end").alias("clock"),
        F.expr("case when event_id % 17 = 0 then value + 1000 else value end").alias("reading"),
        "event_type", "ts",
    )


DIRTY_EVENTS_SQL = """
dirty as (
  select event_id,
    case event_id % 8 when 0 then 'Yes' when 1 then 'N' when 2 then 'true' when 3 then '0'
      when 4 then 'maybe' when 5 then null when 6 then 'y' else 'FALSE' end as flag,
    case when event_id % 11 = 0 then 'n/a' else cast(event_id as varchar) end as whole,
    case when event_id % 7 = 0 then '12.5' else cast(event_id as varchar) end as mixed,
    case when event_id % 9 = 0 then 'x' else cast(value as varchar) end as number,
    case when event_id % 19 = 0 then 'not a date' else strftime(ts, '%m/%d/%Y') end as day,
    case when event_id % 13 = 0 then '25:00:00' else strftime(ts, '%H:%M:%S') end as clock,
    case when event_id % 17 = 0 then value + 1000 else value end as reading,
    event_type, ts
  from events)
"""


def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls: a seventh of the priorities, two thirds of the states, some prices."""
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.expr("case when o_orderkey % 7 = 0 then null else o_orderpriority end").alias("priority"),
        F.expr("case when o_orderkey % 3 = 0 then o_orderstatus end").alias("state"),
        F.expr("case when o_orderkey % 5 = 0 then null else o_totalprice end").alias("price"),
    )


GAPPY_ORDERS_SQL = """
gappy as (
  select o_orderkey, o_custkey, o_orderdate,
    case when o_orderkey % 7 = 0 then null else o_orderpriority end as priority,
    case when o_orderkey % 3 = 0 then o_orderstatus end as state,
    case when o_orderkey % 5 = 0 then null else o_totalprice end as price
  from orders)
"""


def flagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with five flags."""
    return table(spark, folder, "lineitem").select(
        "*",
        (F.col("l_quantity") > 45).alias("big"),
        (F.col("l_discount") >= 0.09).alias("discounted"),
        (F.col("l_tax") == 0).alias("untaxed"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "F").alias("finished"),
    )


FLAGGED_LINES_SQL = """
flagged as (
  select *, l_quantity > 45 as big, l_discount >= 0.09 as discounted, l_tax = 0 as untaxed,
    l_returnflag = 'R' as returned, l_linestatus = 'F' as finished
  from lineitem)
"""
