"""Flag rules, correlation, Cramér's V."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from veinwork.operators import association as A
from veinwork.plans.fixtures import FLAGGED_LINES_SQL, LINE_FLAGS, LINE_NUMBERS, flagged_lines
from veinwork.plans.registry import query
from veinwork.sources.readers import table

_PAIRS_SQL = "pairs as (" + " union all ".join(
    f"select '{a}' as antecedent, '{b}' as consequent, count(*) filter ({a} and {b}) as n_both, "
    f"count(*) filter ({a}) as n_antecedent, count(*) as n_rows from flagged"
    for a, b in combinations(LINE_FLAGS, 2)
) + ")"


@query(f"with {FLAGGED_LINES_SQL}, {_PAIRS_SQL} select * from pairs")
def flag_cooccurrence(spark, folder):
    return A.flag_cooccurrence(flagged_lines(spark, folder), LINE_FLAGS)


@query(f"""
with {FLAGGED_LINES_SQL}, {_PAIRS_SQL}
select antecedent, consequent, round(n_both / n_rows::double, 6) as support,
  round(n_both / n_antecedent::double, 6) as confidence, n_both as n from pairs where n_both > 0
""")
def association_rules(spark, folder):
    return A.association_rules(flagged_lines(spark, folder), LINE_FLAGS)


_NUMBERS = (*LINE_NUMBERS, "net", "discount_gap", "one")
_NUMBERS_SQL = """
numbers as (select l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 - l_discount) as net,
            nullif(l_discount, 0.0) as discount_gap, 1.0::double as one from lineitem)
"""


def _numbers(spark, folder):
    return table(spark, folder, "lineitem").select(
        *LINE_NUMBERS, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount_gap"),
        F.lit(1.0).alias("one"))


def _corr_sql(a: str, b: str) -> str:
    if "one" in (a, b):
        return f"select '{a}' as a, '{b}' as b, null::double as r"
    return f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from numbers"


@query(f"with {_NUMBERS_SQL} " + " union all ".join(
    [_corr_sql(a, b) for a in _NUMBERS for b in _NUMBERS if a != b]
    + [f"select '{a}', '{a}', {'null' if a == 'one' else '1.0::double'}" for a in _NUMBERS]))
def correlation_matrix(spark, folder):
    return A.correlation_matrix(_numbers(spark, folder), _NUMBERS)


@query(f"with {_NUMBERS_SQL}, c as (" + " union all ".join(
    _corr_sql(a, b) for a, b in combinations(_NUMBERS, 2)) + ") select * from c where abs(r) > 0.8")
def high_corr_pairs(spark, folder):
    return A.strong_pairs(_numbers(spark, folder), _NUMBERS)


_CRAMERS = ("p_brand", "p_name", "p_size", "p_retailprice")


_CRAMERS_SQL = f"""
cells as ({' union all '.join(f'''select '{c}' as "column", cast({c} as varchar) as a, p_type as b, count(*) as o
  from part group by all''' for c in _CRAMERS)}),
ra as (select "column", a, sum(o) as na from cells group by all),
rb as (select "column", b, sum(o) as nb from cells group by all),
n as (select "column", sum(o) as n from cells group by all),
grid as (select ra."column", na, nb, n.n as n, coalesce(o, 0) as o, na * nb / n.n::double as e
  from ra join rb on ra."column" = rb."column" join n on n."column" = ra."column"
  left join cells c on c."column" = ra."column" and c.a = ra.a and c.b = rb.b),
chi as (select "column", sum((o - e) * (o - e) / e) as chi2, any_value(n) as n from grid group by 1),
sizes as (select "column", count(distinct a) as n_values, count(distinct b) as n_classes from cells group by 1)
"""


@query(f"""
with {_CRAMERS_SQL}
select "column", n::bigint as n, n_values, n_classes,
  round(sqrt(chi2 / n / (least(n_values, n_classes) - 1)), 6) as cramers_v from chi join sizes using ("column")
""")
def cramers_v(spark, folder):
    return A.cramers_v(table(spark, folder, "part"), _CRAMERS, "p_type")


@query(f"""
with {_CRAMERS_SQL},
v as (select round(sqrt(chi2 / n / (least(n_values, n_classes) - 1)), 6) as v from chi join sizes using ("column"))
select case when v > 0.2 then 'domain and correlation' else 'domain' end as reason, count(*) as n from v group by 1
""")
def selection_reasons(spark, folder):
    scores = A.cramers_v(table(spark, folder, "part"), _CRAMERS, "p_type")
    return A.reason_counts(A.selection_reasons(scores, 0.2))


SUPPORT = 0.0005
_NAMES_SQL = "[" + ", ".join(f"'{f}'" for f in LINE_FLAGS) + "]"
_MASK_SQL = " + ".join(f"({f}::int << {i})" for i, f in enumerate(LINE_FLAGS))
_ITEMSETS_SQL = f"""
rows as (select {_MASK_SQL} as mask, count(*) as n from flagged group by 1),
masks as (select unnest(range(1, {2 ** len(LINE_FLAGS)})) as m),
sets as (select m, sum(case when mask & m = m then n else 0 end)::bigint as n, (select sum(n) from rows)::bigint as total
  from masks, rows where bit_count(m) <= 4 group by m),
frequent as (select m, n, total, array_to_string(list_sort(list_filter({_NAMES_SQL}, lambda f: (m >> (list_position({_NAMES_SQL}, f) - 1)) & 1 = 1)), '+') as items
  from sets where n >= ceil({SUPPORT} * total))
"""


def _itemsets(spark, folder):
    return A.frequent_itemsets(flagged_lines(spark, folder), LINE_FLAGS, SUPPORT)


@query(f"""
with {FLAGGED_LINES_SQL}, {_ITEMSETS_SQL}
select items, n, round(n / total::double, 6) as support from frequent
""")
def flag_itemsets(spark, folder):
    sets, _ = _itemsets(spark, folder)
    return sets.withColumn("items", F.concat_ws("+", "items"))


@query(f"""
with {FLAGGED_LINES_SQL}, {_ITEMSETS_SQL}
select a.items as antecedent, c.items as consequent, s.n, round(s.n / s.total::double, 6) as support,
  round(s.n / a.n::double, 6) as confidence, round(s.n * s.total / (a.n * c.n)::double, 6) as lift
from frequent s join frequent a on a.m & s.m = a.m and bit_count(a.m) = bit_count(s.m) - 1
join frequent c on c.m = s.m - a.m
""")
def flag_itemset_rules(spark, folder):
    _, rules = _itemsets(spark, folder)
    return rules.withColumn("antecedent", F.concat_ws("+", "antecedent"))
