"""Column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.operators import profiling as P
from veinwork.operators import quantiles as Q
from veinwork.operators import sampling
from veinwork.plans.fixtures import FLAGGED_LINES_SQL, GAPPY_ORDERS_SQL, LINE_FLAGS, LINE_NUMBERS
from veinwork.plans.fixtures import flagged_lines, gappy_orders
from veinwork.plans.registry import query
from veinwork.session import durable
from veinwork.sources.readers import table

PART_WORDS = ("p_name", "p_brand", "p_type")


def _unpivot_sql(table_name: str, columns) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", cast({c} as varchar) as value from {table_name}" for c in columns
    )


@query(f"""
select "column", count(distinct value) as n_distinct
from ({_unpivot_sql('part', PART_WORDS)}) group by 1
""")
def distinct_counts(spark, folder):
    return P.distinct_counts(table(spark, folder, "part"), PART_WORDS)


_SUMMARY_COUNTS = """
counts as (select "column", value, count(*) as n from long group by 1, 2),
totals as (select "column", count(value) as n_distinct, sum(n) as n_rows,
                  coalesce(sum(n) filter (value is null), 0) as missing from counts group by 1),
ranked as (select *, row_number() over (partition by "column" order by n desc, value) as rank
           from counts where value is not null)
"""


@query(f"""
with {GAPPY_ORDERS_SQL},
long as (select 'priority' as "column", priority as value from gappy
         union all select 'state', state from gappy
         union all select 'o_custkey', cast(o_custkey as varchar) from gappy
         union all select 'ship_day', strftime(o_orderdate, '%d') from gappy),
{_SUMMARY_COUNTS}
select r."column", n_distinct::bigint as n_distinct, missing::bigint as missing,
  round(missing * 100.0::double / n_rows, 6) as missing_pct, rank, value, n,
  round(n * 100.0::double / n_rows, 6) as pct, n_distinct > 100 as high_cardinality
from ranked r join totals using ("column")
where rank <= case when n_distinct <= 20 then 10 when n_distinct <= 100 then 5 else 1 end
""")
def categorical_summary(spark, folder):
    orders = gappy_orders(spark, folder).withColumn("ship_day", F.date_format("o_orderdate", "dd"))
    return P.categorical_summary(orders, ["priority", "state", "o_custkey", "ship_day"])


@query(f"""
with long as ({_unpivot_sql('part', PART_WORDS)}), {_SUMMARY_COUNTS}
select r."column", rank, value, n from ranked r join totals using ("column")
where rank <= case when n_distinct <= 20 then 20 else 10 end
""")
def category_bars(spark, folder):
    return P.category_bars(table(spark, folder, "part"), PART_WORDS)


@query(f"""
with {FLAGGED_LINES_SQL},
long as ({' union all '.join(f"select '{f}' as column_name, {f} as value from flagged" for f in LINE_FLAGS)})
select column_name as "column", value, count(*) as n,
  round(count(*) * 100.0::double / sum(count(*)) over (partition by column_name), 6) as pct
from long group by column_name, value
""")
def boolean_counts(spark, folder):
    return P.boolean_counts(flagged_lines(spark, folder), LINE_FLAGS)


def _describe_sql(source: str, columns) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 6) as mean,
        round(stddev_samp({c}), 6) as std, min({c})::double as min,
        round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as median,
        round(quantile_cont({c}, 0.75), 6) as q3, max({c})::double as max from {source}"""
        for c in columns
    )


@query(_describe_sql("lineitem", LINE_NUMBERS))
def describe_numeric(spark, folder):
    return P.describe_numeric(table(spark, folder, "lineitem"), LINE_NUMBERS)


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""
with span as (select min({column}) as lo, max({column}) as hi from {source}),
counts as (select least(floor(({column} - lo) * {bins}.0::double / (hi - lo)) + 1, {bins})::int as bin,
                  count(*) as n from {source}, span where {column} is not null group by 1),
grid as (select unnest(range(1, {bins + 1}))::int as bin)
select bin, round(lo + (bin - 1) * (hi - lo) / {bins}.0::double, 6) as low,
  round(lo + bin * (hi - lo) / {bins}.0::double, 6) as high, coalesce(n, 0) as n
from grid left join counts using (bin), span"""


@query(_histogram_sql("lineitem", "l_extendedprice", 50))
def histogram(spark, folder):
    return P.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 50)


@query("""
select count(*) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_keys,
  count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicates from lineitem
""")
def duplicate_count(spark, folder):
    return P.duplicate_count(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
with repeated as (select l_orderkey, count(*) as n from lineitem group by 1 having count(*) > 1)
select l_orderkey, n, (select count(*) from repeated) as repeated_keys
from repeated order by n desc, l_orderkey limit 5
""")
def duplicate_keys_topn(spark, folder):
    return P.duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey", 5)


@query(f"""
with {GAPPY_ORDERS_SQL},
counts as (select 'priority' as "column", count(*) - count(priority) as missing, count(*) as n from gappy
  union all select 'state', count(*) - count(state), count(*) from gappy
  union all select 'price', count(*) - count(price), count(*) from gappy
  union all select 'o_custkey', count(*) - count(o_custkey), count(*) from gappy)
select "column", missing, round(missing * 100.0::double / n, 6) as missing_pct
from counts where missing > 0 order by missing desc, "column" limit 10
""")
def missing_report(spark, folder):
    return P.missing_report(gappy_orders(spark, folder), n=10)


@query("""
select o_orderstatus, count(*) as n, round(count(*) / (sum(count(*)) over ())::double, 4) as share
from orders group by 1
""")
def relative_frequency(spark, folder):
    return P.relative_frequency(table(spark, folder, "orders"), "o_orderstatus")


@query("""
with c as (select o_orderpriority, count(*) as n from orders group by 1)
select max(n) as largest, min(n) as smallest, round(max(n) / min(n)::double, 6) as ratio from c
""")
def imbalance_ratio(spark, folder):
    return P.imbalance_ratio(table(spark, folder, "orders"), "o_orderpriority")


@query(f"""
select "column", count(distinct value) as n_distinct
from ({_unpivot_sql('orders', ('o_custkey', 'o_orderdate', 'o_orderstatus', 'o_orderpriority'))})
group by 1 having count(distinct value) > 100
""")
def high_cardinality(spark, folder):
    columns = ["o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]
    return P.high_cardinality_columns(table(spark, folder, "orders"), columns)


_SPLIT_SQL = """
ranked as (select *, row_number() over (partition by o_orderpriority
             order by md5(cast(o_orderkey as varchar) || '|2025'), o_orderkey) as r,
             count(*) over (partition by o_orderpriority) as n_class from orders),
parts as (select *, case when r <= round_even(n_class * 0.3::double, 0) then 'test' else 'train' end as split
          from ranked)
"""


@query(f"""
with {_SPLIT_SQL},
c as (select split, o_orderpriority, count(*) as n from parts group by 1, 2)
select split, o_orderpriority, n from c
qualify row_number() over (partition by split order by n desc, o_orderpriority) <= 3
""")
def split_distribution(spark, folder):
    parts = sampling.train_test_split(
        table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"),
        ["o_orderpriority"], ["o_orderkey"])
    return P.class_distribution(parts, "o_orderpriority", "split", 3)


@query("""
select o_orderpriority, round(min(o_totalprice), 6) as min, round(quantile_cont(o_totalprice, 0.25), 6) as q1,
  round(quantile_cont(o_totalprice, 0.5), 6) as median, round(quantile_cont(o_totalprice, 0.75), 6) as q3,
  round(max(o_totalprice), 6) as max
from orders group by 1
""")
def five_number_summary(spark, folder):
    return P.five_number_summary(table(spark, folder, "orders"), "o_totalprice", ["o_orderpriority"])


@query("""
select event_type, count(distinct user_id) as n_exact, true as within_bound from events group by 1
""")
def distinct_sketch(spark, folder):
    """Sketches of the users of each day, stored, then merged by kind of event; `within_bound` tells that
    the estimate is within 3 % of the exact count (or one off)."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    sketches = durable(P.distinct_sketches(events, "user_id", ["event_type", "day"]))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_exact"))
    gap = F.abs(F.col("n_distinct") - F.col("n_exact"))
    return P.merged_distinct(sketches, ["event_type"]).join(exact, "event_type").select(
        "event_type", "n_exact", (gap <= F.greatest(F.lit(1.0), 0.03 * F.col("n_exact"))).alias("within_bound"))


@query("""
select event_type, prob::double as prob, count(value) as n, true as within_bound
from events, (values (0.01), (0.25), (0.5), (0.9), (0.99)) p(prob) group by 1, 2
""")
def quantile_sketch(spark, folder):
    """Sketches of the values of each day, stored, then merged; `within_bound` tells that the wanted rank
    lies within 1 % of the rows of the ranks that the value has."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    sketches = durable(Q.quantile_sketches(events, "value", ["event_type", "day"]))
    found = durable(Q.merged_quantiles(sketches, ["event_type"], [0.01, 0.25, 0.5, 0.9, 0.99]))
    ranks = events.join(found.withColumnRenamed("value", "at"), "event_type").groupBy("event_type", "prob", "n").agg(
        F.avg((F.col("value") < F.col("at")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("at")).cast("double")).alias("through"))
    off = F.greatest(F.col("below") - F.col("prob"), F.col("prob") - F.col("through"))
    return ranks.select("event_type", "prob", "n", (off <= 0.01).alias("within_bound"))
