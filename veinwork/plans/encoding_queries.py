"""Label codes, one-hot, scaling, feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.operators import encoding as E
from veinwork.plans.fixtures import FLAGGED_LINES_SQL, GAPPY_ORDERS_SQL, LINE_FLAGS, LINE_NUMBERS
from veinwork.plans.fixtures import flagged_lines, gappy_orders
from veinwork.plans.registry import query
from veinwork.sources.readers import table


@query(f"""
with {GAPPY_ORDERS_SQL},
t as (select o_orderkey, coalesce(priority, 'Unknown') as priority, coalesce(state, 'Unknown') as state from gappy),
p as (select priority, (row_number() over (order by priority) - 1)::int as code from (select distinct priority from t)),
s as (select state, (row_number() over (order by state) - 1)::int as code from (select distinct state from t))
select o_orderkey, p.code as priority_encoded, s.code as state_encoded
from t join p using (priority) join s using (state)
""")
def label_encode(spark, folder):
    orders = gappy_orders(spark, folder).select("o_orderkey", "priority", "state")
    labels = E.fit_labels(orders, ["priority", "state"])
    encoded = E.apply_labels(orders, labels, ["priority", "state"])
    return encoded.select("o_orderkey", "priority_encoded", "state_encoded")


_UNSEEN_SQL = """
split as (select *, case when p_partkey % 3 = 0 then 'test' else 'train' end as split from part),
seen as (select * from split where split = 'train' and p_type <> 'PROMO'),
types as (select p_type, (row_number() over (order by p_type) - 1)::int as code from (select distinct p_type from seen)),
brands as (select p_brand, (row_number() over (order by p_brand) - 1)::int as code from (select distinct p_brand from seen))
"""


def _with_unseen(spark, folder):
    parts = table(spark, folder, "part").withColumn(
        "split", F.when(F.col("p_partkey") % 3 == 0, "test").otherwise("train"))
    seen = parts.filter("split = 'train' and p_type <> 'PROMO'")
    labels = E.fit_labels(seen, ["p_type", "p_brand"])
    return E.apply_labels(parts, labels, ["p_type", "p_brand"], unseen=0, mark_unseen=True)


@query(f"""
with {_UNSEEN_SQL}
select p_partkey, split, coalesce(t.code, 0) as p_type_encoded, coalesce(b.code, 0) as p_brand_encoded
from split left join types t using (p_type) left join brands b using (p_brand)
""")
def label_encode_unseen(spark, folder):
    return _with_unseen(spark, folder).select("p_partkey", "split", "p_type_encoded", "p_brand_encoded")


@query(f"""
with {_UNSEEN_SQL},
e as (select split, t.code is null as t_new, b.code is null as b_new
      from split left join types t using (p_type) left join brands b using (p_brand))
select split, 'p_type' as "column", count(*) filter (t_new) as replaced from e group by 1
union all select split, 'p_brand', count(*) filter (b_new) from e group by 1
""")
def unseen_label_report(spark, folder):
    return E.unseen_report(_with_unseen(spark, folder), ["p_type", "p_brand"], "split")


@query(f"""
with {FLAGGED_LINES_SQL}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, coalesce(nullif(l_discount, 0.0), 0.0) as discount,
  {', '.join(f'{f}::int::double as {f}' for f in LINE_FLAGS)},
  case l_returnflag when 'A' then 0.0::double when 'N' then 1.0::double else 2.0::double end as l_returnflag_encoded
from flagged
""")
def feature_matrix(spark, folder):
    lines = flagged_lines(spark, folder).withColumn(
        "discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))
    labels = E.fit_labels(lines, ["l_returnflag"])
    encoded = E.apply_labels(lines, labels, ["l_returnflag"])
    return E.feature_matrix(
        encoded, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        ["l_quantity", "discount"], LINE_FLAGS, ["l_returnflag_encoded"])


_SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("select c_custkey, c_mktsegment, " + ", ".join(
    f"(c_mktsegment = '{s}')::int as \"c_mktsegment_{s}\"" for s in _SEGMENTS) + " from customer")
def one_hot_drop_first(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return E.one_hot(customers, ["c_mktsegment"])


_STATS = ", ".join(
    f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}, min({c}) as lo_{c}, max({c}) as hi_{c}" for c in LINE_NUMBERS)
_CONSTANT = "0.0::double as one"
_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _scaling_input(spark, folder):
    return table(spark, folder, "lineitem").select(*_KEYS, *LINE_NUMBERS, F.lit(1.0).alias("one"))


def _rounded(df, columns):
    return df.select(*[F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


@query(f"with s as (select {_STATS} from lineitem) select {', '.join(_KEYS)}, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) as {c}" for c in LINE_NUMBERS) + f", {_CONSTANT} from lineitem, s")
def standard_scale(spark, folder):
    lines = _scaling_input(spark, folder)
    columns = [*LINE_NUMBERS, "one"]
    return _rounded(E.fit_standard(lines, columns).transform(lines), columns)


@query(f"with s as (select {_STATS} from lineitem) select {', '.join(_KEYS)}, " + ", ".join(
    f"round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 6) as {c}" for c in LINE_NUMBERS) + f", {_CONSTANT} from lineitem, s")
def minmax_scale(spark, folder):
    lines = _scaling_input(spark, folder)
    columns = [*LINE_NUMBERS, "one"]
    return _rounded(E.fit_minmax(lines, columns).transform(lines), columns)


@query("""
with m as (select case when event_id % 10 = 0 then null else value end as a,
                  case when event_id % 12 = 0 then 'nan'::double else value * 2 end as b,
                  case when event_id % 15 = 0 then 'inf'::double else 1.0::double end as c, value as d from events)
select (count(*) filter (a is null) + count(*) filter (isnan(b)))::bigint as nan_cells,
  count(*) filter (isinf(c)) as inf_cells from m
""")
def matrix_cells(spark, folder):
    events = table(spark, folder, "events").select(
        F.expr("case when event_id % 10 = 0 then null else value end").alias("a"),
        F.expr("case when event_id % 12 = 0 then double('nan') else value * 2 end").alias("b"),
        F.expr("case when event_id % 15 = 0 then double('inf') else 1.0D end").alias("c"),
        F.col("value").alias("d"))
    return E.matrix_quality(events, ["a", "b", "c", "d"]).select("nan_cells", "inf_cells")


@query("""
with s as (select avg(l_quantity) as ma, stddev_pop(l_quantity) as sa, min(l_tax) as lo, max(l_tax) as hi from lineitem),
m as (select (l_quantity - ma) / sa as a, (l_tax - lo) / (hi - lo) as b from lineitem, s)
select 0::bigint as nan_cells, 0::bigint as inf_cells, round((avg(a) + avg(b)) / 2.0::double, 6) as mean_of_means,
  round((stddev_samp(a) + stddev_samp(b)) / 2.0::double, 6) as mean_of_std from m
""")
def matrix_quality(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_tax")
    scaled = E.fit_standard(lines, ["l_quantity"]).transform(lines)
    scaled = E.fit_minmax(lines, ["l_tax"]).transform(scaled)
    return E.matrix_quality(scaled, ["l_quantity", "l_tax"])
