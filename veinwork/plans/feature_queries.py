"""Calendar features, ages and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.functions import binning as B
from veinwork.functions import temporal as T
from veinwork.operators.quantiles import quantile_bins as quantile_bins_
from veinwork.plans.fixtures import DIRTY_EVENTS_SQL, dirty_events
from veinwork.plans.registry import query
from veinwork.sources.readers import table

_HOUR_SQL = "try_strptime(clock, '%H:%M:%S')"


@query(f"""
with {DIRTY_EVENTS_SQL}
select d.event_id, hour({_HOUR_SQL}) as hour, try_cast(split_part(clock, ':', 1) as bigint) as hour_text,
  month(ts) as month, isodow(ts) - 1 as day_of_week,
  case when try_strptime(day, '%m/%d/%Y') is null then 0
       when isodow(try_strptime(day, '%m/%d/%Y')) >= 6 then 1 else 0 end::bigint as is_weekend
from dirty d
""")
def temporal_features(spark, folder):
    dirty = dirty_events(spark, folder)
    day = F.try_to_timestamp("day", F.lit("MM/dd/yyyy"))
    return dirty.select(
        "event_id",
        T.hour_of_clock(F.col("clock")).cast("long").alias("hour"),
        T.hour_before_colon(F.col("clock")).cast("long").alias("hour_text"),
        F.month("ts").cast("long").alias("month"),
        T.day_of_week(F.col("ts")).cast("long").alias("day_of_week"),
        T.weekend_flag(day).cast("long").alias("is_weekend"),
    )


@query(f"""
with {DIRTY_EVENTS_SQL}
select event_id, try_strptime(strftime(try_strptime(day, '%m/%d/%Y'), '%Y-%m-%d') || ' ' || clock,
                              '%Y-%m-%d %H:%M:%S') as at
from dirty
""")
def combine_datetime(spark, folder):
    day = F.try_to_timestamp("day", F.lit("MM/dd/yyyy"))
    return dirty_events(spark, folder).select(
        "event_id", T.join_date_and_clock(day, F.col("clock")).alias("at"))


@query(f"""
with {DIRTY_EVENTS_SQL}, h as (select event_id, hour({_HOUR_SQL}) as hour from dirty)
select event_id,
  case when hour is null then 'Unknown' when hour < 6 then 'Night' when hour < 12 then 'Morning'
       when hour < 18 then 'Afternoon' else 'Evening' end as quarters,
  case when hour is null then 'Unknown' when hour >= 5 and hour < 12 then 'Morning'
       when hour >= 12 and hour < 17 then 'Afternoon' when hour >= 17 and hour < 22 then 'Evening'
       else 'Night' end as late_evening,
  case when hour is null then null when hour >= 5 and hour < 12 then 'Morning'
       when hour >= 12 and hour < 17 then 'Afternoon' when hour >= 17 and hour < 21 then 'Evening'
       else 'Night' end as early_evening
from h
""")
def time_of_day_bands(spark, folder):
    hour = T.hour_of_clock(F.col("clock"))
    return dirty_events(spark, folder).select(
        "event_id", *[T.day_band(hour, s).alias(s) for s in T.DAY_BANDS])


@query("""
select o_orderkey, dayname(o_orderdate) as weekday,
  case when month(o_orderdate) in (12, 1, 2) then 'Winter' when month(o_orderdate) in (3, 4, 5) then 'Spring'
       when month(o_orderdate) in (6, 7, 8) then 'Summer' else 'Fall' end as season
from orders
""")
def weekday_name_season(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", T.weekday_name(day).alias("weekday"), T.season(day).alias("season"))


_YEAR = "case when o_orderkey % 6 = 0 then null else year(o_orderdate) + o_orderkey % 5 - 45 * (o_orderkey % 4 // 3) end"
_YEAR_SPARK = (
    "case when o_orderkey % 6 = 0 then null "
    "else year(o_orderdate) + o_orderkey % 5 - 45 * (o_orderkey % 4 div 3) end"
)


@query(f"""
with y as (select o_orderkey, o_orderdate, {_YEAR} as year from orders)
select o_orderkey, coalesce(2024 - year, 0) as base_2024, coalesce(2025 - year, 0) as base_2025,
  case when year is not null then least(greatest(2025 - year, 0), 50) end as clipped,
  case when year(o_orderdate) - year >= 0 then year(o_orderdate) - year end as at_event
from y
""")
def age_feature(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.expr(_YEAR_SPARK))
    year = F.col("year")
    return orders.select(
        "o_orderkey",
        T.years_since(year, 2024, missing="zero").alias("base_2024"),
        T.years_since(year, 2025, missing="zero").alias("base_2025"),
        T.years_since(year, 2025, clip=(0, 50)).alias("clipped"),
        T.years_since(year, F.year("o_orderdate"), negative_to_null=True).alias("at_event"),
    )


_AGE = "case when p_partkey % 9 = 0 then null else p_size - 1 end"


@query(f"""
with a as (select p_partkey, {_AGE} as age, case when p_partkey % 10 = 0 then null else p_partkey % 24 end as hour
           from part)
select p_partkey, case when age <= 3 then 'New' when age <= 7 then 'Recent' when age <= 15 then 'Middle' else 'Old' end as age_bin,
  case when hour <= 6 then 'Night' when hour <= 12 then 'Morning' when hour <= 18 then 'Afternoon' else 'Evening' end as hour_bin
from a
""")
def ifchain_bins(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", F.expr(_AGE).alias("age"),
        F.expr("case when p_partkey % 10 = 0 then null else p_partkey % 24 end").alias("hour"))
    return parts.select(
        "p_partkey", B.step_label(F.col("age"), *B.AGE_STEPS).alias("age_bin"),
        B.step_label(F.col("hour"), *B.HOUR_STEPS).alias("hour_bin"))


@query(f"""
with a as (select p_partkey, {_AGE} as age from part)
select p_partkey, case when age > -1 and age <= 3 then 'New' when age > 3 and age <= 7 then 'Recent'
  when age > 7 and age <= 15 then 'Middle' when age > 15 and age <= 50 then 'Old' end as band from a
""")
def cut_bins(spark, folder):
    age = F.expr(_AGE)
    return table(spark, folder, "part").select(
        "p_partkey", B.cut_label(age, B.AGE_EDGES, B.AGE_LABELS).alias("band"))


@query("""
with e as (select quantile_cont(l_extendedprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) as p,
                  list_sort(list_distinct(quantile_cont(l_discount, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) as d,
                  list_sort(list_distinct(quantile_cont(l_linenumber * (l_linenumber % 2)::double,
                                                        [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) as o from lineitem),
codes as (
  select l_orderkey, l_linenumber,
    len(list_filter(p[2:-2], lambda x: l_extendedprice > x)) as price_bin,
    len(list_filter(d[2:-2], lambda x: l_discount > x)) as discount_bin,
    len(list_filter(o[2:-2], lambda x: l_linenumber * (l_linenumber % 2) > x)) as odd_bin
  from lineitem, e)
select price_bin, discount_bin, odd_bin, count(*) as n, sum(l_orderkey)::bigint as key_sum from codes group by all
""")
def quantile_bins(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_discount",
        (F.col("l_linenumber") * (F.col("l_linenumber") % 2)).cast("double").alias("odd"))
    names = {"l_extendedprice": "price_bin", "l_discount": "discount_bin", "odd": "odd_bin"}
    binned = quantile_bins_(lines, names, 5)
    return binned.groupBy(*[F.col(n).cast("long").alias(n) for n in names.values()]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))
