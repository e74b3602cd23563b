"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.functions.temporal import weekend_flag
from veinwork.operators import sampling as S
from veinwork.plans.registry import query
from veinwork.sources.readers import table


def _rank_sql(source: str, by: str, key: str) -> str:
    return f"""ranked as (select *, count(*) over (partition by {by}) as n_class,
      row_number() over (partition by {by} order by md5(cast({key} as varchar) || '|2025'), {key}) as r
      from {source})"""


@query(f"""
with {_rank_sql('orders', 'o_orderpriority', 'o_orderkey')}
select o_orderkey, o_orderpriority from ranked
where r <= round_even(n_class * (10000::double / (select count(*) from orders)), 0)
""")
def stratified_sample(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return S.stratified_sample(orders, ["o_orderpriority"], ["o_orderkey"])


@query(f"""
with keyed as (select event_id, concat(hour(ts), '_', (isodow(ts) >= 6)::int, '_', event_type = 'error') as stratum
               from events),
{_rank_sql('keyed', 'stratum', 'event_id')}
select event_id, stratum from ranked
where r <= round_even(n_class * (2000::double / (select count(*) from events)), 0)
""")
def stratified_sample_composite(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.hour("ts").alias("hour"), weekend_flag(F.col("ts")).alias("weekend"),
        (F.col("event_type") == "error").alias("failed"))
    keyed = S.with_stratum(events, ["violation"], ["hour", "weekend", "failed"])
    return S.stratified_sample(keyed, ["stratum"], ["event_id"], size=2000).select("event_id", "stratum")


@query(f"""
with {_rank_sql('orders', 'o_orderpriority', 'o_orderkey')}
select o_orderkey, o_orderpriority,
  case when r <= round_even(n_class * 0.3::double, 0) then 'test' else 'train' end as split from ranked
""")
def train_test_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return S.train_test_split(orders, ["o_orderpriority"], ["o_orderkey"])


@query(f"""
with {_rank_sql('orders', 'o_orderstatus', 'o_orderkey')},
q as (select *, round_even(n_class * 0.2::double, 0) as n_test from ranked)
select o_orderkey, o_orderstatus, case when r <= n_test then 'test'
  when r <= n_test + round_even((n_class - n_test) * 0.25::double, 0) then 'validation' else 'train' end as split
from q
""")
def train_val_test_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return S.train_validation_test_split(orders, ["o_orderstatus"], ["o_orderkey"])


@query(f"""
with {_rank_sql('orders', 'o_orderpriority', 'o_orderkey')}
select o_orderkey, o_orderpriority, ((r - 1) % 5)::int as fold from ranked
""")
def kfold_assign(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return S.stratified_folds(orders, ["o_orderpriority"], ["o_orderkey"])


@query("""
with c as (select o_orderpriority, count(*) as n from orders group by 1)
select o_orderpriority, n, true as within_bound from c
""")
def bernoulli_sample(spark, folder):
    """Rows of each stratum, and whether its sample is within five deviations of its expected size."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    size = 2000
    drawn = S.bernoulli_sample(orders, "o_orderpriority", size).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("drawn"))
    whole = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(size)) / whole.count() / F.col("n"))
    off = F.abs(F.coalesce("drawn", F.lit(0)) - F.col("n") * share)
    return whole.join(drawn, "o_orderpriority", "left").select(
        "o_orderpriority", "n", (off <= 5 * F.sqrt(F.col("n") * share * (1 - share))).alias("within_bound"))
