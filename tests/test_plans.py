"""Plans: what is read, what is shuffled, and where Python runs."""

import contextlib
import io

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veinwork.operators import association, cleaning, profiling, sampling
from veinwork.operators.shape import drop_null
from veinwork.sources.readers import table

# Python runs in these: distance blocks, k-means assignments, and most operators for training data.
PYTHON_QUERIES = {
    "knn", "knn_approximate", "knn_approximate_quality", "knn_distance_outliers", "lof_outliers", "outlier_consensus",
    "outlier_comparison", "outlier_screening", "outlier_screening_approximate", "outlier_screening_groups",
    "outlier_screening_rows", "outlier_screening_sample", "outlier_screening_thousand", "silhouette", "nearest_centroid",
    "inertia", "centroid_outliers", "kmeans_fit", "kmeans_fit_checks", "kmeans_k_sweep", "stop_clustering",
    "stop_clustering_rows", "davies_bouldin", "stop_centroid_outliers", "stop_centroid_outliers_rows",
    "op2_hilbert_shards", "op3_skip_chain_pii", "op4_html_region", "op5_byte_bpe", "op6_nbsvm_quality",
    "op7_recompression_dedup", "op8_rotation_codes", "op9_token_group_join", "op10_simhash_decontamination",
    "op11_fill_in_middle", "op13_length_strata", "pipeline",
}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def stored(monkeypatch):
    """The plans of all tables that a query stores on its way."""
    plans, write = [], DataFrameWriter.parquet

    def seen(self, *args, **options):
        plans.append(plan(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    return plans


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join_and_python_only_where_it_is_listed(spark, folder, name, stored):
    result = plan(entry.queries()[name](spark, folder))
    for text in [result, *stored]:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        if name not in PYTHON_QUERIES:
            assert not any(word in text for word in ("EvalPython", "InPandas", "InArrow", "GroupsInArrow", "CoGroupsInArrow"))


def test_rules_are_one_scan(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_tax") == 0).alias("a"), (F.col("l_discount") > 0.05).alias("b"))
    text = plan(association.association_rules(lines, ["a", "b"]))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "l_quantity" not in text


def test_keep_first_is_cut_before_the_shuffle(spark, folder):
    text = plan(cleaning.keep_first(table(spark, folder, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("Exchange") > tree.index("WindowGroupLimit")


def test_filters_reach_the_scan(spark, folder):
    rule = cleaning.range_rule("q", F.col("l_quantity"), 5.0, 10.0)
    text = plan(cleaning.valid_rows(table(spark, folder, "lineitem"), [rule]).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_quantity,5.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_split_labels_rows_without_shuffling_them(spark, folder):
    parts = sampling.train_test_split(
        table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], ["o_orderkey"])
    assert "hashpartitioning" not in plan(parts)


def test_null_drop_reaches_the_scan(spark, folder):
    kept = drop_null(table(spark, folder, "orders").select("o_orderstatus", "o_totalprice"), ["o_orderstatus"])
    assert "IsNotNull(o_orderstatus)" in plan(kept)


def test_summary_counts_once(spark, folder):
    found = profiling.categorical_summary(table(spark, folder, "part"), ["p_brand", "p_type"])
    found.collect()
    assert "ReusedExchange" in plan(found)
