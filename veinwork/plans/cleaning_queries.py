"""Row cleaning, validation and imputation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from veinwork.functions.parsing import timestamp_from_text
from veinwork.functions.temporal import hour_of_clock
from veinwork.operators import cleaning as C
from veinwork.operators.shape import drop_null, project
from veinwork.plans.fixtures import (
    DIRTY_EVENTS_SQL, FLAGGED_LINES_SQL, GAPPY_ORDERS_SQL, LINE_ORDER,
    dirty_events, flagged_lines, gappy_orders,
)
from veinwork.plans.registry import query
from veinwork.sources.readers import table


@query(f"with {GAPPY_ORDERS_SQL} select o_orderkey, priority, state from gappy "
       "where priority is not null and state is not null")
def drop_null_subset(spark, folder):
    orders = gappy_orders(spark, folder).select("o_orderkey", "priority", "state")
    return drop_null(orders, ["priority", "state"])


@query("""
select p_partkey, p_brand from part
where p_brand in (select p_brand from part group by 1 having count(*) >= 80)
""")
def frequent_class_filter(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return C.frequent_classes(parts, "p_brand", 80)


@query(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(LINE_ORDER)}) = 1
""")
def dedup_keep_first(spark, folder):
    order = [c for c in LINE_ORDER if c not in ("l_orderkey", "l_linenumber")]
    kept = C.keep_first(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("select distinct * from (from lineitem union all from lineitem where l_partkey % 3 = 0)")
def dedup_rows(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.union(lines.filter("l_partkey % 3 = 0")).dropDuplicates()


def event_rules():
    day = timestamp_from_text(F.col("day"))
    return [
        C.range_rule("reading", F.col("reading"), 0.0, 500.0),
        C.present_rule("day_missing", day),
        C.range_rule("day_range", day, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 28)),
        C.present_rule("clock", hour_of_clock(F.col("clock"))),
        C.flag_word_rule("flag", F.col("flag")),
    ]


_RULES_SQL = """
typed as (select *, try_strptime(day, '%m/%d/%Y') as d, try_strptime(clock, '%H:%M:%S') as t,
  coalesce(flag in ('Yes','Y','yes','y','True','true','TRUE','1',
                    'No','N','no','n','False','false','FALSE','0'), false) as known from dirty),
marked as (select *,
  reading < 0 or reading > 500 as bad_reading, d is null as bad_day,
  d < timestamp '2024-01-03' or d > timestamp '2024-01-28' as bad_range,
  t is null as bad_clock, not known as bad_flag,
  reading >= 0 and reading <= 500 as ok_reading,
  d >= timestamp '2024-01-03' and d <= timestamp '2024-01-28' as ok_range from typed)
"""


@query(f"""
with {DIRTY_EVENTS_SQL}, {_RULES_SQL},
c as (select count(*) filter (bad_reading) as a, count(*) filter (bad_day) as b,
  count(*) filter (bad_range) as c, count(*) filter (bad_clock) as d, count(*) filter (bad_flag) as e from marked)
select 'reading' as rule, a as violations from c union all select 'day_missing', b from c
union all select 'day_range', c from c union all select 'clock', d from c
union all select 'flag', e from c union all select 'total', a + b + c + d + e from c
""")
def validation_counts(spark, folder):
    return C.violation_counts(dirty_events(spark, folder), event_rules())


@query(f"""
with {DIRTY_EVENTS_SQL}, {_RULES_SQL}
select event_id, reading, day, clock, flag from marked
where ok_reading and not bad_day and ok_range and not bad_clock and not bad_flag
""")
def validity_filter(spark, folder):
    valid = C.valid_rows(dirty_events(spark, folder), event_rules())
    return valid.select("event_id", "reading", "day", "clock", "flag")


@query(f"with {GAPPY_ORDERS_SQL} select o_orderkey, o_custkey, o_orderdate, priority, price from gappy")
def drop_sparse_columns(spark, folder):
    return C.drop_sparse_columns(gappy_orders(spark, folder))


@query(f"""
with {GAPPY_ORDERS_SQL}
select o_orderkey, coalesce(priority, 'Unknown') as priority, coalesce(price, 0.0::double) as price from gappy
""")
def impute_constant(spark, folder):
    orders = gappy_orders(spark, folder).select("o_orderkey", "priority", "price")
    return C.fill(orders, {"priority": C.UNKNOWN, "price": 0.0})


@query(f"""
with {GAPPY_ORDERS_SQL},
top as (select priority as p from gappy where priority is not null group by 1 order by count(*) desc, 1 limit 1)
select o_orderkey, coalesce(priority, p) as priority from gappy, top
""")
def impute_mode(spark, folder):
    orders = gappy_orders(spark, folder).select("o_orderkey", "priority")
    return C.fill(orders, C.mode_values(orders, ["priority"]))


@query(f"""
with {GAPPY_ORDERS_SQL}
select o_orderkey, round(coalesce(price, (select quantile_cont(price, 0.5) from gappy)), 6) as price from gappy
""")
def impute_median(spark, folder):
    orders = gappy_orders(spark, folder).select("o_orderkey", "price")
    filled = C.fill(orders, C.median_values(orders, ["price"]))
    return filled.withColumn("price", F.round("price", 6))


@query(f"""
with {GAPPY_ORDERS_SQL},
c as (select count(*) as n, count(*) - count(priority) as p, count(*) - count(state) as s,
             count(*) - count(price) as r, quantile_cont(price, 0.5) as m from gappy)
select 'state' as "column", 'dropped' as action, s as missing, round(s * 100.0::double / n, 6) as missing_pct from c
union all select 'priority', 'filled with ''Unknown''', p, round(p * 100.0::double / n, 6) from c
union all select 'price', printf('filled with median (%.2f)', m), r, round(r * 100.0::double / n, 6) from c
""")
def imputation_log(spark, folder):
    _, log = C.impute(gappy_orders(spark, folder), constant=["priority"])
    return log


@query(f"""
with {GAPPY_ORDERS_SQL}
select * from gappy where priority is not null and state is not null and price is not null
""")
def drop_any_null(spark, folder):
    return drop_null(gappy_orders(spark, folder))


@query(f"""
with firsts as (select * from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(LINE_ORDER)}) = 1),
tagged as (select case when l_tax = 0 then 2 when l_quantity > 45 then 3 else 0 end as step from firsts),
c as (select (select count(*) from lineitem) as raw, count(*) as kept,
             count(*) filter (step = 2) as a, count(*) filter (step = 3) as b from tagged)
select 1::bigint as step_no, 'duplicates' as step, raw as rows_before, raw - kept as removed, kept as rows_after from c
union all select 2, 'untaxed', kept, a, kept - a from c
union all select 3, 'oversized', kept - a, b, kept - a - b from c
""")
def cleaning_report(spark, folder):
    order = [c for c in LINE_ORDER if c not in ("l_orderkey", "l_linenumber")]
    stages = [("untaxed", F.col("l_tax") != 0), ("oversized", F.col("l_quantity") <= 45)]
    lines = table(spark, folder, "lineitem")
    return C.cleaning_report(C.keep_first(lines, ["l_orderkey", "l_linenumber"], order), stages, raw=lines)


@query(f"with {FLAGGED_LINES_SQL} select l_orderkey, l_quantity, big, returned from flagged")
def feature_projection(spark, folder):
    wanted = ["l_orderkey", "l_quantity", "big", "returned", "not_in_the_table"]
    return project(flagged_lines(spark, folder), wanted)
