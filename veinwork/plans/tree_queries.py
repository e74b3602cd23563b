"""Decision tree and classifier evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.operators import trees as M
from veinwork.operators.sampling import train_test_split
from veinwork.plans.fixtures import LINE_NUMBERS
from veinwork.plans.registry import query
from veinwork.session import durable
from veinwork.sources.readers import table

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# A predictor that SQL can state: long documents are good ones.
_RULE_SQL = """
preds as (select l.doc_id, cast(quality as varchar) as actual,
  case when n_chars > 1500 then '1' when n_chars > 200 then '0' else 'short' end as predicted
  from labels l join documents d using (doc_id))
"""


def _rule_predictions(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") > 1500, "1").when(F.col("n_chars") > 200, "0").otherwise("short")
    return table(spark, folder, "labels").join(documents, "doc_id").select(
        "doc_id", F.col("quality").cast("string").alias("actual"), guess.alias("predicted"))


@query(f"with {_RULE_SQL} select count(*) as n, round(avg((actual = predicted)::int), 6) as accuracy from preds")
def accuracy(spark, folder):
    return M.accuracy(_rule_predictions(spark, folder), "actual", "predicted")


@query(f"""
with {_RULE_SQL},
names as (select actual as name from preds union select predicted from preds),
cells as (select actual, predicted, count(*) as n from preds group by 1, 2),
grid as (select a.name as actual, p.name as predicted, coalesce(n, 0) as n from names a, names p
  left join cells c on c.actual = a.name and c.predicted = p.name)
select actual, predicted, n, round(case when sum(n) over (partition by actual) > 0
  then n * 100.0::double / sum(n) over (partition by actual) end, 6) as row_pct from grid
""")
def confusion_matrix(spark, folder):
    return M.confusion_matrix(_rule_predictions(spark, folder), "actual", "predicted")


def _gini_sql(column: str) -> str:
    return f"""
select '{column}' as feature, greatest(1, least(32, ceil(({column} - a) * 32.0::double / (b - a))))::int as bin,
  a, (b - a) / 32 as step, l_returnflag as class from lineitem, (select min({column}) as a, max({column}) as b from lineitem)
"""


@query(f"""
with placed as ({' union all '.join(_gini_sql(c) for c in LINE_NUMBERS)}),
counts as (select feature, bin, a, step, class, count(*) as n from placed group by all),
bins as (select distinct feature, bin, a, step from counts),
grid as (select b.feature, b.bin, b.a, b.step, c.class,
    sum(n) filter (o.bin <= b.bin) as n_left, sum(n) as total
  from bins b join (select distinct feature, class from counts) c on c.feature = b.feature
  join counts o on o.feature = b.feature and o.class = c.class group by all),
sums as (select feature, bin, a, step, sum(coalesce(n_left, 0))::double as l, sum(total - coalesce(n_left, 0))::double as r,
    sum(pow(coalesce(n_left, 0), 2))::double as sl, sum(pow(total - coalesce(n_left, 0), 2))::double as sr
  from grid group by all having l > 0 and r > 0),
scored as (select *, round(((l - sl / l) + (r - sr / r)) / (l + r), 9) as gini from sums)
select feature, bin, round(a + bin * step, 6) as threshold, l::bigint as n_left, r::bigint as n_right,
  round(gini, 6) as gini from scored
qualify row_number() over (partition by feature order by gini, bin) = 1
""")
def gini_split(spark, folder):
    return M.best_splits(table(spark, folder, "lineitem"), "l_returnflag", LINE_NUMBERS)


def _labelled_lines(spark, folder):
    """Line items whose class depends on two numbers, with a tenth of the labels scrambled."""
    lines = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    truth = F.when(F.col("l_quantity") <= 15, "small").when(price <= 2000, "cheap").otherwise("dear")
    scrambled = F.element_at(
        F.array(F.lit("small"), F.lit("cheap"), F.lit("dear")), (F.col("l_partkey") % 3 + 1).cast("int"))
    noisy = F.when(F.col("l_orderkey") % 10 == 0, scrambled).otherwise(truth)
    return lines.select(*_KEYS, *LINE_NUMBERS, price.alias("unit_price"), noisy.alias("class"))


_FEATURES = [*LINE_NUMBERS, "unit_price"]


@query()
def tree_fit_predict(spark, folder):
    parts = durable(train_test_split(_labelled_lines(spark, folder), ["class"], _KEYS))
    tree = M.fit_tree(parts.filter("split = 'train'"), "class", _FEATURES)
    predicted = parts.withColumn("predicted", tree.predict())
    return predicted.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col("class") == F.col("predicted")).cast("double")), 6).alias("accuracy"))


@query()
def tree_cross_validation(spark, folder):
    return M.validation_summary(M.cross_validate(_labelled_lines(spark, folder), "class", _FEATURES, _KEYS))


@query()
def feature_importance(spark, folder):
    lines = _labelled_lines(spark, folder)
    return M.importance_table(lines, M.fit_tree(lines, "class", _FEATURES), 10)


@query()
def tree_rules(spark, folder):
    lines = _labelled_lines(spark, folder)
    return M.rule_table(lines, M.fit_tree(lines, "class", _FEATURES), 3)


def _exact_gini_sql(column: str) -> str:
    return f"select '{column}' as feature, {column}::double as v, l_returnflag as class from lineitem"


@query(f"""
with long as ({' union all '.join(_exact_gini_sql(c) for c in LINE_NUMBERS)}),
counts as (select feature, v, count(*) as n, count(*) filter (class = 'A') as a, count(*) filter (class = 'N') as b,
  count(*) filter (class = 'R') as c from long group by 1, 2),
run as (select feature, v, lead(v) over w as next,
    sum(n) over w as n, sum(a) over w as a, sum(b) over w as b, sum(c) over w as c,
    sum(n) over p as tn, sum(a) over p as ta, sum(b) over p as tb, sum(c) over p as tc
  from counts window w as (partition by feature order by v), p as (partition by feature)),
scored as (select feature, v, next, n::bigint as n_left, (tn - n)::bigint as n_right,
    round(((n - (a * a + b * b + c * c) / n::double)
      + ((tn - n) - (pow(ta - a, 2) + pow(tb - b, 2) + pow(tc - c, 2)) / (tn - n)::double)) / tn::double, 9) as gini
  from run where next is not null)
select feature, round((v + next) / 2, 6) as threshold, n_left, n_right, round(gini, 6) as gini from scored
qualify row_number() over (partition by feature order by gini, v) = 1
""")
def gini_split_exact(spark, folder):
    return M.best_exact_splits(table(spark, folder, "lineitem"), "l_returnflag", LINE_NUMBERS)
