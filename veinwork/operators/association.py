"""Co-occurrence of flags, correlation of numbers, association of categories."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.operators.shape import col, rows_from
from veinwork.session import durable

STRONG_CORRELATION = 0.8


def flag_cooccurrence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """`(antecedent, consequent, n_both, n_antecedent, n_rows)` for each pair in list order.

    All pairs and singles come from one aggregate over one scan.
    """
    pairs = list(combinations(range(len(flags)), 2))
    true = [col(f).cast("boolean") for f in flags]
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(t).alias(f"_s{i}") for i, t in enumerate(true)],
        *[F.count_if(true[i] & true[j]).alias(f"_p{i}_{j}") for i, j in pairs],
    )
    return rows_from(one, [
        F.struct(
            F.lit(flags[i]).alias("antecedent"), F.lit(flags[j]).alias("consequent"),
            F.col(f"_p{i}_{j}").alias("n_both"), F.col(f"_s{i}").alias("n_antecedent"),
            F.col("_rows").alias("n_rows"),
        )
        for i, j in pairs
    ])


def association_rules(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Support, confidence and count of the pairs that occur at all."""
    return flag_cooccurrence(df, flags).filter("n_both > 0").select(
        "antecedent", "consequent",
        F.round(F.col("n_both") / F.col("n_rows"), 6).alias("support"),
        F.round(F.col("n_both") / F.col("n_antecedent"), 6).alias("confidence"),
        F.col("n_both").alias("n"),
    )


def frequent_itemsets(df: DataFrame, flags: Sequence[str], support: float, size: int = 4) -> tuple[DataFrame, DataFrame]:
    """Sets of up to `size` flags that are true together in at least a share `support` of the rows, and
    the rules between them: `(items, n, support)` and `(antecedent, consequent, n, support, confidence,
    lift)`, where a rule leads from one to `size` - 1 flags to one more, in every direction.

    MLlib's parallel FP-growth: each task mines the sets of its own flags in a compressed tree.
    """
    rows = durable(df.select(F.array_compact(F.array(*[F.when(col(f).cast("boolean"), F.lit(f)) for f in flags])).alias("items")))
    total = rows.count()
    if not total:
        none = df.sparkSession.createDataFrame
        return (none([], "items array<string>, n long, support double"),
                none([], "antecedent array<string>, consequent string, n long, support double, confidence double, lift double"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(rows)
    share = lambda n: F.round(n / F.lit(float(total)), 6)
    found = durable(model.freqItemsets.filter(F.size("items") <= size).select(F.array_sort("items").alias("items"), F.col("freq").alias("n")))
    sets = found.select("items", "n", share(F.col("n")).alias("support"))
    larger = found.filter(F.size("items") > 1).select(
        F.col("n"), "items", F.explode("items").alias("consequent")).withColumn(
        "antecedent", F.array_except("items", F.array("consequent")))
    known = lambda side, count: found.select(F.col("items").alias(side), F.col("n").alias(count))
    one = known("one", "n_consequent").filter(F.size("one") == 1).select(F.col("one")[0].alias("consequent"), "n_consequent")
    # Every part of a frequent set is frequent, so both joins find their row.
    rules = larger.join(known("antecedent", "n_antecedent"), "antecedent").join(one, "consequent").select(
        "antecedent", "consequent", "n", share(F.col("n")).alias("support"),
        F.round(F.col("n") / F.col("n_antecedent"), 6).alias("confidence"),
        F.round(F.col("n") * total / (F.col("n_antecedent") * F.col("n_consequent")), 6).alias("lift"))
    return sets, rules


def _correlated(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """One row with `_i_j` for each pair i<j and `_i_i` for each column, from one aggregate
    after one that finds out which columns have gaps."""
    pairs = list(combinations(range(len(columns)), 2))
    v = [F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in columns]
    gaps = df.agg(*[F.count_if(x.isNull()) for x in v]).first()

    def beside(i, j):
        # Without gaps in j every pair of i shares its moments, which Spark computes once.
        return F.when(v[j].isNotNull(), v[i]) if gaps[j] else v[i]

    def r(i, j):
        # Merged moments of a constant come out as noise, not 0; so extremes tell a constant.
        a, b = beside(i, j), beside(j, i)
        vary = (F.max(a) > F.min(a)) & (F.max(b) > F.min(b))
        spread = F.var_pop(a) * F.var_pop(b)
        return F.when(vary, F.round(F.try_divide(F.covar_pop(v[i], v[j]), F.sqrt(spread)), 6))

    one = df.agg(
        *[r(i, j).alias(f"_{i}_{j}") for i, j in pairs],
        *[F.when(F.max(x) > F.min(x), 1.0).alias(f"_{i}_{i}") for i, x in enumerate(v)],
    )
    return one, pairs


def _pair_rows(one: DataFrame, columns: Sequence[str], wanted: Sequence[tuple[int, int]]) -> DataFrame:
    return rows_from(one, [
        F.struct(
            F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"),
            F.col(f"_{min(i, j)}_{max(i, j)}").alias("r"),
        )
        for i, j in wanted
    ])


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's r of each pair i<j over the rows where both are present."""
    one, pairs = _correlated(df, columns)
    return _pair_rows(one, columns, pairs)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(a, b, r)` for all ordered pairs, the diagonal included (null for a constant)."""
    one, _ = _correlated(df, columns)
    every = range(len(columns))
    return _pair_rows(one, columns, [(i, j) for i in every for j in every])


def strong_pairs(df: DataFrame, columns: Sequence[str], above: float = STRONG_CORRELATION) -> DataFrame:
    return pair_correlations(df, columns).filter(F.abs("r") > above)


def cramers_v(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Cramér's V of each column against the target, rows with a null in either left out.

    Chi-square over n equals the sum of n_ij^2 / (n_i * n_j), less one, in which absent
    cells add nothing; so only the cells that occur are ever built.
    """
    pairs = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    cells = (
        df.filter(col(target).isNotNull())
        .select(col(target).cast("string").alias("class"), F.inline(F.array(*pairs)))
        .filter("value is not null")
        .groupBy("column", "value", "class").agg(F.count(F.lit(1)).alias("n"))
    )
    classes = durable(cells.groupBy("column", "class").agg(F.sum("n").alias("n_class")))
    per_value = (
        cells.join(classes, ["column", "class"])
        .groupBy("column", "value")
        .agg(
            F.sum("n").alias("n_value"),
            F.sum(F.col("n") * F.col("n") / F.col("n_class")).alias("part"),
        )
    )
    per_column = per_value.groupBy("column").agg(
        (F.sum(F.col("part") / F.col("n_value")) - 1).alias("phi2"),
        F.count(F.lit(1)).alias("n_values"), F.sum("n_value").alias("n"),
    )
    n_classes = classes.groupBy("column").agg(F.count(F.lit(1)).alias("n_classes"))
    freedom = F.least(F.col("n_values"), F.col("n_classes")) - 1
    v = F.sqrt(F.greatest(F.col("phi2"), F.lit(0.0)) / freedom)
    return per_column.join(n_classes, "column").select(
        "column", "n", "n_values", "n_classes", F.when(freedom > 0, F.round(v, 6)).alias("cramers_v")
    )


def selection_reasons(scores: DataFrame, informed_above: float) -> DataFrame:
    """Why a feature is kept: its association with the target, or domain knowledge alone."""
    return scores.select(
        "column", "cramers_v",
        F.when(F.col("cramers_v") > informed_above, "domain and correlation")
        .otherwise("domain").alias("reason"),
    )


def reason_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
