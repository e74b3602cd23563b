"""Nearest neighbours, outlier scores and their consensus."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinwork.operators import outliers as O
from veinwork.operators.approximate import approximate_neighbours
from veinwork.operators.neighbours import nearest_neighbours
from veinwork.plans.registry import query
from veinwork.sources.readers import table

_KNN_SQL = """
gaps as (select a.vec_id as id, b.vec_id as neighbor, sqrt(list_sum(list_transform(
    list_zip(a.embedding, b.embedding),
    lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double)))) as distance
  from embeddings a join embeddings b on a.vec_id <> b.vec_id),
edges as (select *, row_number() over (partition by id order by distance, neighbor) as rank from gaps
  qualify rank <= 20)
"""
_DISTANCE_SQL = """
mean_d as (select id, avg(distance) as score from edges group by 1),
by_distance as (select id, score, score > (select quantile_cont(score, 0.99) from mean_d) as distance_outlier from mean_d)
"""
_LOF_SQL = """
kd as (select id, max(distance) as k_distance from edges group by 1),
density as (select e.id, 1.0::double / (avg(greatest(distance, k_distance)) + 1e-10) as lrd
  from edges e join kd on kd.id = e.neighbor group by 1),
lof as (select e.id, avg(n.lrd) / any_value(o.lrd) as lof
  from edges e join density n on n.id = e.neighbor join density o on o.id = e.id group by 1),
by_lof as (select id, lof, lof > (select quantile_cont(lof, 0.99) from lof) as lof_outlier from lof)
"""


def _vectors(spark, folder):
    return table(spark, folder, "embeddings")


@query(f"with {_KNN_SQL} select id, neighbor, rank::int as rank, round(distance, 6) as distance from edges")
def knn(spark, folder):
    edges = nearest_neighbours(_vectors(spark, folder), "vec_id", "embedding", 20)
    return edges.withColumn("distance", F.round("distance", 6))


@query(f"""
with {_KNN_SQL}, {_DISTANCE_SQL}
select id, round(score, 6) as distance_score, distance_outlier from by_distance
""")
def knn_distance_outliers(spark, folder):
    edges = nearest_neighbours(_vectors(spark, folder), "vec_id", "embedding", 20)
    scores = O.distance_scores(edges)
    return O.flag_above_quantile(scores, "distance_score", 0.01, "distance_outlier").withColumn(
        "distance_score", F.round("distance_score", 6))


@query(f"with {_KNN_SQL}, {_LOF_SQL} select id, round(-lof, 6) as lof_score, lof_outlier from by_lof")
def lof_outliers(spark, folder):
    edges = nearest_neighbours(_vectors(spark, folder), "vec_id", "embedding", 20)
    marked = O.flag_above_quantile(O.lof_scores(edges), "lof", 0.01, "lof_outlier")
    return marked.select("id", F.round(-F.col("lof"), 6).alias("lof_score"), "lof_outlier")


@query(f"""
with {_KNN_SQL}, {_DISTANCE_SQL}, {_LOF_SQL},
f as (select lof_outlier as a, distance_outlier as b from by_lof join by_distance using (id)),
c as (select count(*) filter (a and not b) as first_only, count(*) filter (b and not a) as second_only,
  count(*) filter (a and b) as agreed, count(*) filter (not a and not b) as neither from f)
select *, round(agreed * 100.0::double / (agreed + first_only), 6) as agreement_first_pct,
  round(agreed * 100.0::double / (agreed + second_only), 6) as agreement_second_pct from c
""")
def outlier_consensus(spark, folder):
    return O.consensus(O.screen(_vectors(spark, folder), "vec_id", "embedding"))


@query(f"""
with {_KNN_SQL}, {_DISTANCE_SQL}, {_LOF_SQL}
select lof_outlier or distance_outlier as any_outlier, count(*) as n,
  round(avg((label < 5)::int) * 100.0::double, 6) as low_label_pct, round(avg(label), 6) as label_mean
from by_lof join by_distance using (id) join embeddings on vec_id = id group by 1
""")
def outlier_comparison(spark, folder):
    vectors = _vectors(spark, folder)
    flags = O.screen(vectors, "vec_id", "embedding").select(
        "vec_id", (F.col("lof_outlier") | F.col("distance_outlier")).alias("any_outlier"))
    marked = vectors.select("vec_id", "label", (F.col("label") < 5).alias("low_label")).join(flags, "vec_id")
    return O.compare_groups(marked, "any_outlier", ["low_label"], ["label"])


RECALL_ROWS = 64  # points of a bucket, so few that also a small table is cut


def _approximate(spark, folder):
    return approximate_neighbours(_vectors(spark, folder), "vec_id", "embedding", 20, trees=24, bucket_rows=RECALL_ROWS)


@query()
def knn_approximate(spark, folder):
    return _approximate(spark, folder).withColumn("distance", F.round("distance", 6))


@query("""
select count(*) as n_points, 20 * count(*) as n_edges, 0 as n_nearer, true as recall_reached from embeddings
""")
def knn_approximate_quality(spark, folder):
    """Against the exact neighbours: edges found, edges nearer than the exact one of that rank (none can
    be), and whether at least 0.9 of the exact edges are among them."""
    exact = nearest_neighbours(_vectors(spark, folder), "vec_id", "embedding", 20)
    found = _approximate(spark, folder)
    both = exact.select("id", "rank", F.col("neighbor").alias("wanted"), F.col("distance").alias("least")).join(
        found.select("id", "rank", "distance"), ["id", "rank"], "left")
    hit = exact.join(found.select("id", "neighbor"), ["id", "neighbor"], "left_semi").count()
    return both.agg(
        F.count_distinct("id").alias("n_points"), F.count("distance").alias("n_edges"),
        F.count_if(F.col("distance") < F.col("least")).alias("n_nearer"), (F.lit(hit) >= 0.9 * F.count("*")).alias("recall_reached"))
