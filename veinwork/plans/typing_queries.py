"""Scans, typing and the metrics sink."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from veinwork.functions import parsing
from veinwork.operators.profiling import non_null_counts, preview, table_shape
from veinwork.plans.fixtures import DIRTY_EVENTS_SQL, dirty_events
from veinwork.plans.registry import query
from veinwork.session import shared_folder
from veinwork.sources.readers import read_csv_checked, table
from veinwork.sources.schema import FieldSpec, coerce, coercion_report
from veinwork.sources.sinks import metrics, metrics_report

EVENT_FIELDS = (
    FieldSpec("flag", "flag"), FieldSpec("whole", "whole"), FieldSpec("mixed", "whole"),
    FieldSpec("number", "double"), FieldSpec("day", "timestamp"), FieldSpec("event_type", "text"),
    FieldSpec("absent", "double"),
)

_TYPED = """
  coalesce(flag in ('Yes','Y','yes','y','True','true','TRUE','1'), false) as flag,
  try_cast(whole as bigint) as whole,
  case when try_cast(mixed as double) = floor(try_cast(mixed as double))
       then cast(try_cast(mixed as double) as bigint) end as mixed,
  try_cast(number as double) as number,
  try_strptime(day, '%m/%d/%Y') as day
"""


@query(f"with {DIRTY_EVENTS_SQL} select event_id, {_TYPED}, clock, reading, event_type from dirty")
def coerce_schema(spark, folder):
    return coerce(dirty_events(spark, folder).drop("ts"), EVENT_FIELDS)


@query("select count(*) as n_rows, 11 as n_columns from lineitem")
def table_shape_(spark, folder):
    return table_shape(table(spark, folder, "lineitem"))


@query("select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 5")
def preview_topn(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return preview(orders, ["o_orderkey"], 5)


@query(f"""
with {DIRTY_EVENTS_SQL}
select 'event_id' as "column", 'bigint' as data_type, count(event_id) as non_null from dirty
union all select 'flag', 'string', count(flag) from dirty
union all select 'whole', 'string', count(whole) from dirty
union all select 'event_type', 'string', count(event_type) from dirty
""")
def column_info(spark, folder):
    return non_null_counts(dirty_events(spark, folder).select("event_id", "flag", "whole", "event_type"))


@query("""
select 'orders' as section, 'rows' as metric, count(*)::double as value from orders
union all select 'orders', 'mean_price', round(avg(o_totalprice), 6) from orders
union all select 'orders', 'distinct_customers', count(distinct o_custkey)::double from orders
union all select 'lines', 'rows', count(*)::double from lineitem
union all select 'lines', 'max_quantity', max(l_quantity) from lineitem
""")
def metrics_report_(spark, folder):
    orders = metrics(table(spark, folder, "orders"), "orders", {
        "rows": F.count(F.lit(1)), "mean_price": F.avg("o_totalprice"),
        "distinct_customers": F.count_distinct("o_custkey"),
    })
    lines = metrics(table(spark, folder, "lineitem"), "lines", {
        "rows": F.count(F.lit(1)), "max_quantity": F.max("l_quantity"),
    })
    return metrics_report([orders, lines])


@query(f"with {DIRTY_EVENTS_SQL} select event_id, try_strptime(day, '%m/%d/%Y') as day from dirty")
def coerce_timestamp(spark, folder):
    return dirty_events(spark, folder).select(
        "event_id", parsing.timestamp_from_text(F.col("day")).alias("day"))


@query(f"""
with {DIRTY_EVENTS_SQL}
select event_id, coalesce(flag in ('Yes','Y','yes','y','True','true','TRUE','1'), false) as flag,
  reading <> 0 as truthy
from dirty
""")
def coerce_boolean(spark, folder):
    return dirty_events(spark, folder).select(
        "event_id", parsing.flag_from_words(F.col("flag")).alias("flag"),
        parsing.flag_from_value(F.col("reading")).alias("truthy"))


@query(f"""
with {DIRTY_EVENTS_SQL}
select event_id, try_cast(number as double) as number, try_cast(whole as bigint) as whole,
  case when try_cast(mixed as double) = floor(try_cast(mixed as double))
       then cast(try_cast(mixed as double) as bigint) end as mixed
from dirty
""")
def coerce_numeric(spark, folder):
    return dirty_events(spark, folder).select(
        "event_id", parsing.double_from_text(F.col("number")).alias("number"),
        parsing.whole_from_text(F.col("whole")).alias("whole"),
        parsing.whole_from_text(F.col("mixed")).alias("mixed"))


@query(f"""
with {DIRTY_EVENTS_SQL},
words as (select flag in ('Yes','Y','yes','y','True','true','TRUE','1',
                          'No','N','no','n','False','false','FALSE','0') as known from dirty),
typed as (select flag as raw_flag, whole as raw_whole, mixed as raw_mixed, number as raw_number,
                 day as raw_day, event_type, {_TYPED} from dirty)
select 'flag' as field, 'flag' as target, count(*) filter (known) as converted,
       count(*) filter (not known) as lost from words
union all select 'whole', 'whole', count(whole), count(raw_whole) - count(whole) from typed
union all select 'mixed', 'whole', count(mixed), count(raw_mixed) - count(mixed) from typed
union all select 'number', 'double', count(number), count(raw_number) - count(number) from typed
union all select 'day', 'timestamp', count(day), count(raw_day) - count(day) from typed
union all select 'event_type', 'text', count(event_type), 0 from typed
""")
def coercion_report_(spark, folder):
    return coercion_report(dirty_events(spark, folder), EVENT_FIELDS)


LINE_FIELDS = (
    FieldSpec("order", "whole"), FieldSpec("line", "whole"), FieldSpec("quantity", "double"), FieldSpec("note", "text"))


@query("""
with made as (select *, case when l_partkey % 97 = 0 then 'long' when l_suppkey % 41 = 0 then 'short' else 'good' end as kind
  from lineitem)
select count(*) as n_lines, count(*) filter (kind = 'good') as n_good, count(*) filter (kind = 'short') as n_short,
  count(*) filter (kind = 'long') as n_long, round(sum(l_quantity) filter (kind = 'good'), 6) as quantity,
  count(distinct l_orderkey) filter (kind = 'good') as n_orders,
  count(*) filter (kind = 'good' and l_returnflag = 'A') as n_quoted from made
""")
def csv_line_report(spark, folder):
    """Line items written out as text, some lines with a field too many or too few, and read back."""
    whole = F.concat_ws(
        ",", "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_returnflag") == "A", '"a, ""quoted"" note"').otherwise("plain"))
    line = F.when(F.expr("l_partkey % 97 = 0"), F.concat(whole, F.lit(",more"))).when(
        F.expr("l_suppkey % 41 = 0"), F.concat_ws(",", "l_orderkey", "l_linenumber")).otherwise(whole)
    path = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    table(spark, folder, "lineitem").select(line.alias("value")).write.text(path)
    rows, bad = read_csv_checked(spark, path, LINE_FIELDS)
    kind = F.when(F.col("fields") < len(LINE_FIELDS), "short").otherwise("long")
    lines = rows.withColumn("kind", F.lit("good")).unionByName(bad.select(kind.alias("kind")), allowMissingColumns=True)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("good", "short", "long")],
        F.round(F.sum("quantity"), 6).alias("quantity"), F.count_distinct("order").alias("n_orders"),
        F.count_if(F.col("note") == 'a, "quoted" note').alias("n_quoted"))
