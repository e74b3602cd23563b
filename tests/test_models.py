"""Invariants of fitted models, which SQL cannot state."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veinwork.operators import association as A
from veinwork.operators import cleaning as K
from veinwork.operators import clustering as C
from veinwork.operators import outliers as O
from veinwork.operators import trees as M
from veinwork.plans import stop_analysis as S
from veinwork.plans.stop_queries import STOP_KEYS, STOP_ORDER, stops
from veinwork.plans.tree_queries import _FEATURES, _KEYS, _labelled_lines
from veinwork.session import durable


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    places = np.vstack([rng.normal(size=(60, 2)) * 0.3 + c for c in ((0, 0), (5, 5), (0, 6))])
    rows = [(i, [float(v) for v in p], i // 60) for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "id long, x array<double>, truth int").repartition(3), places


def _truth_scores(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == l].mean() for l in set(labels) if l != labels[i])
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_kmeans_finds_blobs(spark, blobs):
    df, _ = blobs
    for model in (C.fit_kmeans(df, "x", 3, restarts=3), C.k_sweep(df, "id", "x", [2, 3], restarts=3)[1][3]):
        near = C.nearest_centroid(df, "x", model.by_id())
        pairs = near.groupBy("truth").agg(F.count_distinct("cluster").alias("c")).collect()
        assert all(r["c"] == 1 for r in pairs)
        assert np.isclose(near.agg(F.sum(F.col("distance") ** 2)).first()[0], model.inertia)


def test_sweep(spark, blobs):
    df, x = blobs
    table, models = C.k_sweep(df, "id", "x", ks=[2, 3, 4], restarts=3)
    found = {r["k"]: r for r in table.collect()}
    assert found[2]["inertia"] > found[3]["inertia"] > found[4]["inertia"]
    assert found[3]["silhouette_rank"] == found[3]["davies_bouldin_rank"] == 1
    labels = np.array([r["cluster"] for r in C.nearest_centroid(df, "x", models[3].by_id()).orderBy("id").collect()])
    assert np.isclose(found[3]["silhouette"], _truth_scores(x, labels), atol=1e-6)


def test_silhouette_of_a_lone_row(spark):
    x = np.array([[0.0, 0], [0, 1], [5, 5], [0, 1]])
    labels = np.array([0, 0, 1, 0])
    df = spark.createDataFrame([(i, p.tolist(), int(l)) for i, (p, l) in enumerate(zip(x, labels))], "id long, x array<double>, l int")
    assert np.isclose(C.silhouette(df, "id", "x", ["l"]).first()["silhouette"], _truth_scores(x, labels), atol=1e-6)


def test_regions(spark):
    rows = [(float(a), float(b)) for a, b in ((0, 0), (0, 1), (9, 9), (9, 8))] * 50 + [(None, 1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    model = C.fit_regions(df, "lat", "lon", regions=2, restarts=2)
    marked = C.assign_regions(df, model, "lat", "lon")
    assert sorted(r["count"] for r in marked.groupBy("region").count().collect()) == [1, 100, 100]
    assert np.isclose(model.inertia, 50.0 * 2 * 2 * 0.25)


def test_projection(spark):
    x = np.random.default_rng(0).normal(size=(200, 4)) @ np.diag([5.0, 2.0, 1.0, 0.5])
    x -= x.mean(axis=0)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, x array<double>")
    placed, ratios = C.project(df, "id", "x")
    found = np.array([[r["pc1"], r["pc2"]] for r in placed.orderBy("id").collect()])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    signs = np.sign(vt[np.arange(2), np.abs(vt[:2]).argmax(axis=1)])
    assert np.allclose(found, x @ (vt[:2] * signs[:, None]).T)
    assert np.allclose(ratios, (s**2 / (s**2).sum())[:2])


def test_tree(spark, folder):
    lines = _labelled_lines(spark, folder)
    tree = M.fit_tree(lines, "class", _FEATURES)
    assert np.isclose(sum(tree.importances().values()), 1.0)
    assert all(n.rows >= 20 for n in tree.nodes.values())
    assert all(n.rows >= 50 for n in tree.nodes.values() if not n.is_leaf)
    by_leaf = {r["leaf"]: r["count"] for r in lines.groupBy(tree.leaf().alias("leaf")).count().collect()}
    assert by_leaf == {i: n.rows for i, n in tree.nodes.items() if n.is_leaf}
    hit = lines.agg(F.avg((F.col("class") == tree.predict()).cast("double"))).first()[0]
    assert hit > 0.9
    pruned = M.fit_tree(lines, "class", _FEATURES, min_split_rows=3000)
    assert all(n.rows >= 3000 for n in pruned.nodes.values() if not n.is_leaf)


def test_cross_validation(spark, folder):
    scores = M.cross_validate(_labelled_lines(spark, folder), "class", _FEATURES, _KEYS)
    rows = scores.collect()
    assert len(rows) == 5 and sum(r["n"] for r in rows) == 6000 and all(r["accuracy"] > 0.85 for r in rows)


def test_stop_analyses(spark, folder):
    typed = stops(spark, folder)
    result = S.screen_outliers(typed, STOP_ORDER, fit_rows=600)
    flags = result["flags"].toPandas()
    valid, _ = S.clean_for_outliers(typed, STOP_ORDER)
    assert flags["SeqID"].is_unique and len(flags) == valid.count()  # every valid row, not the sample
    steps = result["cleaning"].orderBy("step_no").collect()
    assert steps[0]["rows_before"] == 6000 and [r["step"] for r in steps][0] == "duplicates"
    assert all(a["rows_after"] == b["rows_before"] for a, b in zip(steps, steps[1:]))
    quality = result["matrix"].first()
    assert quality["nan_cells"] == quality["inf_cells"] == 0 and abs(quality["mean_of_means"]) < 1e-6
    assert sum(r["n"] for r in result["comparison"].collect()) == len(flags)
    classified = S.classify(typed, STOP_KEYS, fit_rows=1500, min_class_rows=500)
    assert sum(r["n"] for r in classified["confusion"].collect()) == classified["accuracy"].filter(
        "split = 'test'").first()["n"]
    clustered = S.cluster(typed, STOP_KEYS, judged_rows=600, k=3, ks=[2, 3], restarts=2)
    assert sum(r["n"] for r in clustered["sizes"].collect()) == clustered["outliers"].count()
    assert clustered["profile"].count() == 3
    assert clustered["outliers"].count() == 6000


def test_screening_takes_neighbours_from_all_rows(spark, folder, monkeypatch):
    given = []
    screen = O.screen
    monkeypatch.setattr(O, "screen", lambda df, *rest: given.append(df) or screen(df, *rest))
    flags = S.screen_outliers(stops(spark, folder), STOP_ORDER)["flags"].toPandas().set_index("SeqID")
    assert len(given) == 1  # not a sample, whatever the number of rows
    rows = given[0].toPandas()
    x = np.stack(rows["features"].to_numpy())
    assert len(rows) == len(flags)
    for i in range(0, len(rows), 97):
        near = np.sort(np.sqrt(((x - x[i]) ** 2).sum(axis=1)))[1 : O.NEIGHBOURS + 1]
        assert np.isclose(flags.loc[rows["SeqID"][i], "distance_score"], near.mean())


def test_sample_screen_is_the_whole_screen_for_a_whole_sample(spark):
    x = np.random.default_rng(3).normal(size=(120, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, x array<double>")
    whole = O.screen(df, "id", "x", 5, 0.05).orderBy("id").toPandas()
    sampled = O.screen_by_sample(df, df, "id", "x", 5, 0.05).orderBy("id").toPandas()
    assert np.allclose(whole[["distance_score", "lof_score"]], sampled[["distance_score", "lof_score"]])
    assert (whole["common_outlier"] == sampled["common_outlier"]).all()
    part = O.screen_by_sample(df, df.filter("id < 60"), "id", "x", 5, 0.05).toPandas()
    assert len(part) == 120 and np.isfinite(part["lof_score"]).all()


def test_sweep_of_constant_rows(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "id long, x array<double>")
    table, _ = C.k_sweep(df, "id", "x", ks=[2, 3], restarts=1)
    rows = table.collect()
    assert [r["davies_bouldin"] for r in rows] == [None, None] and {r["davies_bouldin_rank"] for r in rows} == {1, 2}


def test_sweep_of_repeated_vectors(spark):
    rows = [(i, [0.0, 0.0]) for i in range(400)] + [(400 + i, [float(i % 20), 5.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found = {r["k"]: r["inertia"] for r in C.k_sweep(df, "id", "x", ks=[2, 6], restarts=2)[0].collect()}
    assert found[6] < found[2]


def test_silhouette_of_text_and_missing_labels(spark):
    rows = [(0, [0.0], "a"), (1, [1.0], "a"), (2, [9.0], "b"), (3, [8.0], "b"), (4, [5.0], None)]
    df = spark.createDataFrame(rows, "id long, x array<double>, l string")
    want = _truth_scores(np.array([[0.0], [1], [9], [8]]), np.array([0, 0, 1, 1]))
    assert np.isclose(C.silhouette(df, "id", "x", ["l"]).first()["silhouette"], want, atol=1e-6)


@pytest.mark.parametrize("partitions", [1, 3, 4, 17])
def test_correlation_with_a_constant_is_null(spark, partitions):
    rows = [(float(i % 7) / 10, 1.0, 1.1, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, one double, other double, b double").repartition(partitions)
    found = {(r["a"], r["b"]): r["r"] for r in A.correlation_matrix(df, ["a", "one", "other", "b"]).collect()}
    assert all(v is None for (x, y), v in found.items() if {"one", "other"} & {x, y})
    assert found["a", "b"] is not None and found["a", "a"] == 1.0
    assert A.strong_pairs(df, ["a", "one", "other"]).count() == 0


def test_imputation_of_times_and_flags(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 4)]
    df = spark.createDataFrame(
        [(days[0], True), (days[1], True), (days[2], False), (None, None)], "at timestamp, yes boolean")
    filled, log = K.impute(df)
    assert filled.filter("at is null or yes is null").count() == 0
    assert filled.filter("at = timestamp '2024-01-02' and yes").count() == 2
    assert {r["column"]: r["missing"] for r in log.collect()} == {"at": 1, "yes": 1}


def test_stop_preparation(spark, folder):
    typed = stops(spark, folder)
    result = S.prepare(typed)
    steps = {r["column"]: r["action"] for r in result["imputation"].collect()}
    assert steps == {"Make": "filled with 'Unknown'", "Search Outcome": "dropped"}
    built = result["constructed"]
    bands = {r["LatitudeBand"] for r in built.select("LatitudeBand").distinct().collect()}
    assert bands == {0, 1, 2, 3, 4}
    encoded = result["encoded"]
    assert encoded.count() == built.count() and "Race_encoded" in encoded.columns and "Race" not in encoded.columns
    gone = result["replaced"].filter("split = 'train'").agg(F.sum("replaced")).first()[0]
    assert gone == 0


def test_centroid_screen(spark):
    with pytest.raises(ValueError):
        S.centroid_screen(stops(spark, "/root/testdata/sf0.001").filter("false"), STOP_ORDER)
    result = S.centroid_screen(stops(spark, "/root/testdata/sf0.01"), STOP_ORDER, restarts=2)
    marked = result["marked"].toPandas()
    assert len(marked) and marked["cluster"].nunique() == 5
    limit = np.percentile(marked["distance"], 95)
    assert (marked["is_outlier"] == (marked["distance"] > limit)).all()


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "common_outlier" in found.columns


def test_all_starts_of_a_sweep_share_their_passes(spark, blobs):
    """Three k of two starts each take as many passes as the slowest start, not the sum of all."""
    df, x = blobs
    vectors = durable(df.select("x"))
    passes, run = [], type(vectors).mapInArrow

    def counted(self, *args, **options):
        passes.append(1)
        return run(self, *args, **options)

    pairs = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(vectors), "mapInArrow", counted)
        together = C._fit_all(vectors, [2, 3, 5], 2, 300, 7, 2, stored=True)
        shared = len(passes)
        for ks in ([2, 3], [2, 5], [3, 5]):
            passes.clear()
            C._fit_all(vectors, ks, 2, 300, 7, 2, stored=True)
            pairs.append(len(passes))
    assert shared == max(pairs)
    for k in (2, 3, 5):  # MLlib's own fit
        alone = C._fit_all(vectors, [k], 2, 300, 7, 2, stored=True)[k]
        assert np.allclose(alone.centers, together[k].centers) and np.isclose(alone.inertia, together[k].inertia)


def test_seeding_deals_large_partitions_anew(spark, monkeypatch):
    """A partition that would take too much decoded is dealt to several; every row still counts."""
    monkeypatch.setattr(C, "PART_VALUES", 18 * 40)
    df = spark.createDataFrame([(float(i % 2) * 100 + i / 1000, 1.0) for i in range(400)], "lat double, lon double").coalesce(1)
    seen, fit = [], C.KMeans.fit

    def watched(self, rows, *args):
        seen.append((rows.rdd.getNumPartitions(), rows.agg({"weight": "sum"}).first()[0]))
        return fit(self, rows, *args)

    monkeypatch.setattr(C.KMeans, "fit", watched)
    model = C.fit_regions(df, "lat", "lon", regions=2, restarts=1)
    assert seen == [(10, 400.0)] and np.allclose(sorted(c[0] for c in model.centers), [0.199, 100.2], atol=0.01)


def test_linear_silhouette_stores_no_copy_of_the_rows(blobs, monkeypatch):
    df, written = blobs[0], []
    monkeypatch.setattr(C, "durable", lambda table: written.append(table.columns) or durable(table))
    assert C.linear_silhouette(df, "x", "truth") > 0.5
    assert written == [["label", "code"]]


def test_silhouette_copies_grow_with_the_cores_not_the_rows(spark, blobs, monkeypatch):
    """Blocks are few, and compared in pieces; the scores are those of the definition."""
    df, x = blobs
    assert [C._blocks(n, 12) for n in (100, 5_000, 160_000, 500_000)] == [1, 5, 5, 16]
    monkeypatch.setattr(C, "BLOCK_ROWS", 70)
    monkeypatch.setattr(C, "_PIECE_CELLS", 500)
    labels = np.array([r["truth"] for r in df.orderBy("id").collect()])
    assert np.isclose(C.silhouette(df, "id", "x", ["truth"]).first()["silhouette"], _truth_scores(x, labels), atol=1e-6)


def test_least_values_of_wide_rows():
    """The columns of the least values, also with ties, with infinite values and in narrow rows."""
    rng = np.random.default_rng(11)
    for width in (30, 5_000):
        values = np.round(rng.normal(size=(40, width)), 2)
        values[:, 3] = np.inf
        found = O._least(values, 20)
        assert all(len(set(row)) == 20 for row in found.tolist())
        assert (np.sort(np.take_along_axis(values, found, axis=1)) == np.sort(values, axis=1)[:, :20]).all()


def test_trees_fitted_together_are_those_fitted_alone(spark):
    """Over values that are few enough to be split anywhere, MLlib's trees; every row of a part is counted."""
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 40, 3_000), rng.integers(0, 2, 3_000), rng.integers(0, 7, 3_000) / 4
    label = np.where(a + rng.normal(size=3_000) < 15, "x", np.where(b > 0, "y", np.where(c > 1, "z", "x")))
    rows = spark.createDataFrame(
        [(str(v), float(i), int(j), float(k), n % 3 != 0) for n, (v, i, j, k) in enumerate(zip(label, a, b, c))],
        "class string, a double, b int, c double, some boolean")
    splits = M.candidate_splits(rows, ["a", "b", "c"])
    assert splits["b"] == [0.5] and len(splits["a"]) == 39
    coded = M.code_features(rows, splits).withColumn("all", F.lit(True))
    found = M.fit_trees(coded, "class", splits, ["all", "some"], ["x", "y", "z"])
    for tree, part in zip(found, [rows, rows.filter("some")]):
        alone = M.fit_tree(part, "class", ["a", "b", "c"])
        assert tree.nodes[0].rows == part.count() and len(tree.nodes) > 5
        assert [r[1:4] + r[5:] for r in tree.rules()] == [r[1:4] + r[5:] for r in alone.rules()]
        guess = coded.select(M.over_codes(tree, splits).predict().alias("p")).groupBy("p").count().collect()
        assert sorted(guess) == sorted(rows.select(tree.predict().alias("p")).groupBy("p").count().collect())


def test_thresholds_of_many_values_are_quantiles_of_all_rows(spark):
    rows = spark.range(100_000).select(F.sqrt("id").alias("v"))
    splits = M.candidate_splits(rows, ["v"])["v"]
    assert len(splits) == 255
    assert np.allclose(splits, np.quantile(np.sqrt(np.arange(100_000)), np.arange(1, 256) / 256))
    assert rows.limit(0).count() == 0 and M.candidate_splits(rows.limit(0), ["v"]) == {"v": []}


def test_classification_is_fitted_on_all_rows(spark, folder, monkeypatch):
    """The root of each tree holds all training rows, whatever their number."""
    monkeypatch.setattr("veinwork.operators.sampling.SAMPLE_ROWS", 100)
    trees, fit = [], M.fit_trees
    monkeypatch.setattr(M, "fit_trees", lambda *a, **o: trees.extend(fit(*a, **o)) or trees)
    result = S.classify(stops(spark, folder), STOP_KEYS, min_class_rows=500)
    assert [t.nodes[0].rows for t in trees] == [4200, *[6000 - r["n"] for r in result["folds"].orderBy("fold").collect()]]
    assert result["rules"].first()["rows"] == 4200
    assert sum(r["n"] for r in result["confusion"].collect()) == 1800


def test_scores_of_all_labelings_take_two_passes(spark, monkeypatch):
    """As each labeling by itself, also with clusters without rows or of one row."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) + rng.integers(0, 3, (300, 1)) * 4
    codes = np.stack([rng.integers(0, 4, 300), np.where(np.arange(300) == 7, 5, rng.integers(1, 3, 300)), np.zeros(300, int)], axis=1)
    rows = durable(spark.createDataFrame(
        [(i, [float(v) for v in p], *map(int, c)) for i, (p, c) in enumerate(zip(x, codes))], "id long, x array<double>, a int, b int, c int"))
    alone = {n: (C.linear_silhouette(rows, "x", n), C.davies_bouldin_value(rows, "x", n)) for n in "abc"}
    passes, mapped = [], type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, *a, **o: (passes.append(1), mapped(self, *a, **o))[1])
    found = C.linear_scores(rows, "x", {"a": 4, "b": 7, "c": 1})
    assert len(passes) == 2
    assert found["c"] == alone["c"] == (None, None)
    assert all(np.allclose(found[n], alone[n], rtol=1e-9) for n in "ab")
    assert C.linear_scores(rows.limit(0), "x", {"a": 4}) == {"a": (None, None)}


def test_a_pair_of_groups_is_compared_once(spark, monkeypatch):
    """Both groups of a pair get their sums from one task, and the silhouette is the exact one."""
    monkeypatch.setattr(C, "_blocks", lambda total, parallel: 4)
    monkeypatch.setattr(C, "COLUMNS", 16)
    monkeypatch.setattr(C, "CACHED_CELLS", 100)
    rng = np.random.default_rng(6)
    x, labels = rng.normal(size=(150, 3)), rng.integers(0, 3, 150)
    x[:20] = x[0]
    sent, sums = spark.sparkContext.accumulator(0), C._cluster_sums

    def counted(offsets, width):
        inner = sums(offsets, width)
        return lambda visitors, block: (sent.add(0 if visitors.empty or block.empty else 1), inner(visitors, block))[1]

    monkeypatch.setattr(C, "_cluster_sums", counted)
    rows = spark.createDataFrame([(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, labels))], "id long, x array<double>, c int")
    found = C.silhouette_rows(rows, "id", "x", ["c"]).toPandas().set_index("id").sort_index()["silhouette"]
    assert sent.value == 10  # pairs of four groups, each with itself too
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    means = np.stack([d[:, labels == c].mean(axis=1) for c in range(3)], axis=1)
    n = np.bincount(labels)[labels]
    own = means[np.arange(150), labels] * n / (n - 1)
    means[np.arange(150), labels] = np.inf
    assert np.allclose(found, (means.min(axis=1) - own) / np.maximum(own, means.min(axis=1)), atol=1e-6)


def test_a_preparation_leaves_one_copy_of_the_rows(spark, folder, monkeypatch):
    import os

    from veinwork.operators import encoding as E

    kept = []
    for module in (S, E):
        monkeypatch.setattr(module, "durable", lambda df: kept.append(durable(df)) or kept[-1])
    result = S.prepare(stops(spark, folder))
    left = [table.columns for table in kept if os.path.exists(table.stored_at.removeprefix("file:"))]
    assert len(left) == 2 and "split" in left[0] and left[1] == ["column", "value", "code"]
    assert result["constructed"].count() == result["encoded"].count() == sum(r["n"] for r in result["distribution"].collect()) > 0
    assert result["imbalance"].count() == 1 and result["replaced"].count() > 0
