"""The ways taken beyond a size limit give the same results as the ways below it, also when
one group or value holds much of the table."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veinwork.functions.hashing import hash_key
from veinwork.operators import (
    approximate, association, clustering, encoding, neighbours, profiling, quantiles, ranking, sampling, trees,
)
from veinwork.operators.approximate import approximate_neighbours
from veinwork.operators.neighbours import nearest_neighbours
from veinwork.operators.outliers import screen
from veinwork.operators.quantiles import exact_quantiles
from veinwork.sources.readers import read_csv_checked
from veinwork.sources.schema import FieldSpec, coerce

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("name,values", [
    ("plain", np.random.default_rng(0).normal(size=2000)),
    ("ties", np.r_[np.zeros(900), np.arange(100.0), np.full(500, 7.0)]),
    ("tail", np.random.default_rng(1).lognormal(0, 6, size=2000)),
    ("huge", np.r_[np.arange(50.0), 1e300, -1e300]),
    ("one", np.array([3.5])),
    ("constant", np.full(40, -2.0)),
])
def test_quantiles_by_histogram(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    for small in (10**6, 3):  # counted after the first round, or refined until a bin holds three rows
        found = exact_quantiles(df, ["v"], PROBS, small=small).first()["quantiles"]
        assert np.allclose(found, np.percentile(values, [100 * p for p in PROBS]), rtol=1e-12, atol=1e-12)


def test_quantiles_by_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.rand(3) * 100).alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    def table(limit):
        return {(r["g"], r["column"]): r["quantiles"] for r in
                exact_quantiles(df, ["a", "b"], PROBS, ["g"], small=limit).collect()}
    small, large = table(10**6), table(5)
    plain = df.groupBy("g").agg(F.percentile("a", F.array(*[F.lit(p) for p in PROBS])).alias("q")).collect()
    assert small.keys() == large.keys()
    assert all(np.allclose(small[r["g"], "a"], r["q"], rtol=1e-12) for r in plain)
    for key in small:
        assert np.allclose(small[key], large[key], rtol=1e-12)


def _plain_rank(df, by, key):
    order = W.partitionBy(*by).orderBy(hash_key([key]), key)
    return df.withColumn("plain", F.row_number().over(order))


@pytest.mark.parametrize("bucket_rows,partitions", [(10**6, 1), (50, 4), (50, 17)])
def test_rank_in_buckets_is_the_plain_rank(spark, monkeypatch, bucket_rows, partitions):
    monkeypatch.setattr(ranking, "_BUCKET_ROWS", bucket_rows)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "x").alias("s"))
    ranked = ranking.stratified_rank(df.repartition(partitions), ["s"], ["id"], 3000, "rank")
    both = _plain_rank(ranked, ["s"], "id")
    assert both.count() == 3000 and both.filter("rank <> plain").count() == 0


@pytest.mark.parametrize("bucket_rows", [10**6, 40])
def test_sample_takes_the_first_of_each_stratum(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(ranking, "_BUCKET_ROWS", bucket_rows)
    sizes = {"a": 1, "b": 2, "c": 5, "d": 25, "hot": 2000, None: 30}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "id int, s string")
    sample = sampling.stratified_sample(df, ["s"], ["id"], size=200)
    share = 200 / len(rows)
    found = {r["s"]: r["count"] for r in sample.groupBy("s").count().collect()}
    assert found == {s: round(share * n) for s, n in sizes.items() if s and round(share * n)}
    kept = {r["id"] for r in sample.collect()}
    ranks = _plain_rank(df.filter("s is not null"), ["s"], "id").collect()
    assert kept == {r["id"] for r in ranks if r["plain"] <= round(share * sizes[r["s"]])}
    assert sampling.stratified_sample(df, ["s"], ["id"], size=10**6).count() == len(rows) - sizes[None]


def test_splits_and_folds(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).alias("s"))
    parts = sampling.train_validation_test_split(df, ["s"], ["id"])
    found = {(r["s"], r["split"]): r["count"] for r in parts.groupBy("s", "split").count().collect()}
    assert found == {(True, "test"): 29, (True, "validation"): 28, (True, "train"): 86,
                     (False, "test"): 171, (False, "validation"): 172, (False, "train"): 514}
    folds = [r["count"] for r in sampling.stratified_folds(df, ["s"], ["id"]).groupBy("fold").count().collect()]
    assert len(folds) == 5 and sum(folds) == 1000 and max(folds) - min(folds) <= 2


def test_label_codes_by_splitters(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("same prefix "), F.col("id") % 1900).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("string").alias("b"))
    labels = encoding.fit_labels(df, ["a", "b"])
    values = {"a": sorted(f"same prefix {i}" for i in range(1900)), "b": ["0", "1", "2", "Unknown"]}
    want = sorted((c, v, i) for c, names in values.items() for i, v in enumerate(names))
    assert sorted(map(tuple, labels.collect())) == want
    code = {(c, v): i for c, v, i in want}
    for r in encoding.apply_labels(df, labels, ["a", "b"]).collect():
        assert r["a_encoded"] == code["a", r["a"]] and r["b_encoded"] == code["b", r["b"] or "Unknown"]


def _brute(ids, x, k):
    out = []
    for i in range(len(x)):
        total = np.zeros(len(x))
        for j in range(x.shape[1]):
            total += (x[i, j] - x[:, j]) ** 2
        d = np.sqrt(total)
        order = np.lexsort((ids, d))
        order = order[ids[order] != ids[i]][:k]
        out += [(int(ids[i]), int(ids[n]), r + 1, d[n]) for r, n in enumerate(order)]
    return sorted(out)


_RNG = np.random.default_rng(5)
_CLOUDS = {
    "copies": np.vstack([np.zeros((300, 3)), _RNG.integers(0, 4, size=(400, 3)).astype(float)]),
    "grid": np.array([[a, b] for a in range(30) for b in range(30)], float),
    "clusters": np.vstack([_RNG.normal(size=(500, 4)) * 0.01 + 5, _RNG.normal(size=(300, 4)), np.ones((300, 4))]),
    "far": _RNG.normal(size=(800, 3)) + 1e6,
    "few": _RNG.normal(size=(4, 3)),
}


def _frame(spark, ids, x, partitions=4):
    rows = [(int(i), [float(v) for v in p]) for i, p in zip(ids, x)]
    return spark.createDataFrame(rows, "id long, x array<double>").repartition(partitions)


@pytest.mark.parametrize("cloud", sorted(_CLOUDS))
@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 40}])
def test_neighbours_are_exact(spark, monkeypatch, cloud, sizes):
    monkeypatch.setattr(neighbours, "_PIECE_CELLS", 700)
    monkeypatch.setattr(neighbours, "PACK_BYTES", 200)
    monkeypatch.setattr(neighbours, "_COMPACT", 3)
    monkeypatch.setattr(neighbours, "ASSIGN_ROWS", 100)
    x = _CLOUDS[cloud]
    ids = np.random.default_rng(1).permutation(len(x)) * 3
    edges = nearest_neighbours(_frame(spark, ids, x), "id", "x", 6, **sizes)
    assert sorted((r["id"], r["neighbor"], r["rank"], r["distance"]) for r in edges.collect()) == _brute(ids, x, 6)


def test_screen_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(380, 3)), rng.normal(size=(15, 3)) * 8, np.zeros((5, 3))])
    ids, k = np.arange(len(x)), 20
    edges = _brute(ids, x, k)
    near = np.array([e[1] for e in edges]).reshape(-1, k)
    d = np.array([e[3] for e in edges]).reshape(-1, k)
    reach = np.maximum(d, d[near].max(axis=2))
    density = 1 / (reach.mean(axis=1) + 1e-10)
    lof = density[near].mean(axis=1) / density
    score = d.mean(axis=1)
    found = screen(_frame(spark, ids, x), "id", "x", k, 0.05).orderBy("id").toPandas()
    assert np.allclose(found["distance_score"], score) and np.allclose(found["lof_score"], -lof)
    assert (found["distance_outlier"] == (score > np.percentile(score, 95))).all()
    assert (found["lof_outlier"] == (lof > np.percentile(lof, 95))).all()
    assert (found["common_outlier"] == (found["lof_outlier"] & found["distance_outlier"])).all()
    assert found["common_outlier"].sum() <= min(found["lof_outlier"].sum(), found["distance_outlier"].sum())


def test_text_ids(spark):
    x = _RNG.normal(size=(60, 2))
    df = spark.createDataFrame([(f"id-{i}", [float(v) for v in p]) for i, p in enumerate(x)], "id string, x array<double>")
    edges = nearest_neighbours(df, "id", "x", 3, leaf_rows=9).collect()
    want = {(f"id-{a}", f"id-{b}") for a, b, _, _ in _brute(np.arange(60), x, 3)}
    assert {(r["id"], r["neighbor"]) for r in edges} == want


@pytest.mark.parametrize("times", [1, 4])
def test_what_leaves_the_search_is_one_list_per_point(spark, monkeypatch, times):
    given = []
    edges_of = neighbours.edges_of
    monkeypatch.setattr(neighbours, "edges_of", lambda rows, points, lists, k: (given.append(lists.selectExpr("size(near) as n").collect()), edges_of(rows, points, lists, k))[1])
    x = np.random.default_rng(6).normal(size=(400 * times, 5))
    edges = nearest_neighbours(_frame(spark, np.arange(len(x)), x), "id", "x", 6, leaf_rows=50)
    assert [r["n"] for r in given[0]] == [7] * len(x) and edges.count() == 6 * len(x)


@pytest.mark.parametrize("values,size", [(np.float32([0.1, -7.5, 3e30]), 4), ([0.1, -7.5, 3e30], 8), ([0.5, 1e300, 2.0], 8)])
def test_packs_are_in_single_precision_where_nothing_is_lost(values, size):
    x = np.asarray(values, float)[np.random.default_rng(10).integers(0, 3, (90, 4))]
    block = pa.table({
        "p": np.arange(90), "x": pa.array(x.tolist(), pa.list_(pa.float64())), "ids": [[i] for i in range(90)], "full": [i == 4 for i in range(90)],
        "cell": pa.array([0] * 90, pa.int32()), "block": [3] * 90})
    packs = neighbours._packer(5, pa.int64())(block)
    assert sum(len(b) for b in packs["x"].to_pylist()) == size * x.size
    back = neighbours._unpack(packs.combine_chunks().to_batches()[0])
    assert back[0].dtype == np.float64 and (back[0] == x).all() and back[1].to_pylist() == [[i] for i in range(90)]


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_a_search_holds_points_in_single_precision_where_nothing_is_lost(kind):
    x = np.random.default_rng(12).normal(size=(300, 5)).astype(kind).astype(float)
    search = neighbours.Search(x, 4)
    assert search.x.dtype == kind
    search.meet(x, pa.array([[i] for i in range(300)]), np.arange(300), x.mean(axis=0), np.inf)
    rows, distance, ids = search.result()
    plain = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    assert ids.to_numpy().reshape(300, 4).tolist() == np.argsort(plain, axis=1, kind="stable")[:, :4].tolist()
    assert np.allclose(distance.reshape(300, 4), np.sort(plain, axis=1)[:, :4], rtol=1e-14, atol=0)


def _packed_blocks(x, blocks, width):
    pack, found = neighbours._packer(width, pa.int64()), []
    for b in range(blocks):
        ids = np.arange(b, len(x), blocks)
        found.append(pack(pa.table({
            "p": ids, "x": pa.array(x[ids].tolist(), pa.list_(pa.float64())), "ids": [[i] for i in ids], "full": [False] * len(ids),
            "cell": pa.array([0] * len(ids), pa.int32()), "block": [b] * len(ids)})))
    return found


def test_packs_are_small_and_only_the_first_has_the_center():
    packs = _packed_blocks(np.random.default_rng(13).normal(size=(400, 64)).astype(np.float32).astype(float), 1, 5)[0]
    assert packs["center"].null_count == len(packs) - 1 and packs["first"].to_pylist() == [True, *[False] * (len(packs) - 1)]
    assert packs.select(["block", "center", "radius", "x", "full", "ids"]).nbytes < 800 * len(packs)  # 8 MB in a batch of 10,000


@pytest.mark.parametrize("size", [1, 4, 7, 1000])
def test_batches_may_end_within_a_block(monkeypatch, size):
    monkeypatch.setattr(neighbours, "PACK_BYTES", 100)
    x = np.random.default_rng(14).normal(size=(240, 3))
    rows = []
    for group in ([0, 2], [1, 3]):  # each meets its own blocks first
        for b, packs in sorted(enumerate(_packed_blocks(x, 4, 6)), key=lambda one: one[0] not in group):
            gap = -np.inf if b in group else 0.0
            rows.append(packs.append_column("a", pa.array([group[0]] * len(packs))).append_column("gap", pa.array([gap] * len(packs))))
    batches = pa.concat_tables(rows).combine_chunks().to_batches(max_chunksize=size)
    found = {p: [e["neighbor"] for e in near] for batch in neighbours._searcher(6, pa.int64())(batches)
             for p, near in zip(batch["p"].to_pylist(), batch["near"].to_pylist(), strict=True)}
    plain = np.argsort(((x[:, None] - x) ** 2).sum(axis=2), axis=1, kind="stable")[:, :6]
    assert found == dict(enumerate(plain.tolist()))


def test_points_meet_few_pivots_in_bounded_pieces(monkeypatch):
    pieces, squares = [], neighbours.rough_squares
    monkeypatch.setattr(neighbours, "_PIECE_CELLS", 640)
    monkeypatch.setattr(neighbours, "rough_squares", lambda q, r: (pieces.append(q.size), squares(q, r))[1])
    x = np.random.default_rng(11).normal(size=(400, 64))
    found = neighbours._nearest_pivot(x, x[:3])
    assert max(pieces) <= 640  # also where points have more dimensions than there are pivots
    assert (found == ((x[:, None] - x[:3]) ** 2).sum(axis=2).argmin(axis=1)).all()


def _recall(exact, found):
    want = {(r["id"], r["neighbor"]) for r in exact.collect()}
    return len(want & {(r["id"], r["neighbor"]) for r in found.collect()}) / len(want)


@pytest.mark.parametrize("cloud", ["clusters", "copies", "grid"])
def test_approximate_neighbours_find_most(spark, cloud):
    x = _CLOUDS[cloud]
    df = _frame(spark, np.arange(len(x)) * 2, x)
    exact = nearest_neighbours(df, "id", "x", 6)
    found = approximate_neighbours(df, "id", "x", 6, trees=16, bucket_rows=60)
    assert _recall(exact, found) >= 0.9
    pairs = exact.select("id", "rank", F.col("distance").alias("least")).join(found, ["id", "rank"])
    assert pairs.filter("distance < least").count() == 0  # distances are exact, so none can be nearer


def test_approximate_neighbours_of_text_ids_and_no_rows(spark):
    x = _RNG.normal(size=(300, 3))
    df = spark.createDataFrame([(f"id-{i}", [float(v) for v in p]) for i, p in enumerate(x)], "id string, x array<double>")
    assert _recall(nearest_neighbours(df, "id", "x", 4), approximate_neighbours(df, "id", "x", 4, trees=16, bucket_rows=40)) >= 0.9
    assert approximate_neighbours(df.limit(0), "id", "x", 4).count() == nearest_neighbours(df.limit(0), "id", "x", 4).count() == 0


def test_bucket_sizes_are_bounded(spark, monkeypatch):
    sizes = []
    search = approximate._nearest
    monkeypatch.setattr(approximate, "edges_of", lambda rows, points, lists, k: lists)
    x = np.vstack([_RNG.normal(size=(900, 2)) * 1e-9, _RNG.normal(size=(100, 2))])  # nearly all in one place

    def counting(width, kind):
        run = search(width, kind)
        return lambda bucket: (run(bucket) if bucket.num_rows <= 200 else 1 / 0)

    monkeypatch.setattr(approximate, "_nearest", counting)
    lists = approximate_neighbours(_frame(spark, np.arange(1000), x), "id", "x", 3, trees=4, bucket_rows=50)
    assert lists is not None and not sizes


@pytest.mark.parametrize("id_type", [pa.int64(), pa.string()])
def test_small_buckets_are_compared_together(monkeypatch, id_type):
    rng = np.random.default_rng(9)
    sizes = [1, 2, 3, 150, 40, 7, 128, 129, 30]
    leaf = np.repeat(np.arange(len(sizes)), sizes)
    names = [f"{i:04}" if id_type == pa.string() else i for i in range(sum(sizes))]
    ids = [[n] if i % 5 else [n, *([n + "x"] if id_type == pa.string() else [n + 10_000])] for i, n in enumerate(names)]
    rows = pa.table({
        "p": pa.array(names, id_type), "x": pa.array(rng.integers(0, 4, (len(leaf), 3)).astype(float).tolist(), pa.list_(pa.float64())),  # many ties
        "ids": pa.array(ids, pa.list_(id_type)), "full": pa.array(np.arange(len(leaf)) % 11 == 3), "leaf": pa.array(leaf), "part": pa.array(leaf * 0)})
    alone, calls = approximate._nearest(6, id_type), []
    monkeypatch.setattr(approximate, "_nearest", lambda *a: lambda bucket: (calls.append(bucket.num_rows), alone(bucket))[1])
    found = pa.Table.from_batches(approximate._in_buckets(6, id_type)(rows.to_batches(max_chunksize=25))).sort_by("p")
    starts = np.cumsum([0, *sizes])
    want = pa.concat_tables([alone(rows.slice(a, n)) for a, n in zip(starts, sizes)]).sort_by("p")
    assert found.to_pylist() == want.to_pylist()
    assert sorted(calls) == [129, 150]  # a call for each small bucket took most of the time


def test_points_are_stored_once_and_not_for_each_tree(spark, monkeypatch):
    stored, write = [], approximate.durable

    def seen(df):
        out = write(df)
        if "x" in out.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(approximate, "durable", seen)
    approximate_neighbours(_frame(spark, np.arange(150), _RNG.normal(size=(150, 3))), "id", "x", 3, trees=4, bucket_rows=40)
    assert stored and set(stored) == {150}


@pytest.mark.parametrize("ranges", [1, 7])
def test_exact_splits_against_brute_force(spark, ranges):
    rng = np.random.default_rng(7)
    a = np.where(rng.random(600) < 0.5, 3.0, rng.integers(0, 40, 600))  # a value that half of the rows share
    b, label = rng.normal(size=600), rng.choice(["x", "y", "z"], 600)
    label[b > 0.7] = "x"
    rows = [(float(u), float(v), 1.0, str(c)) for u, v, c in zip(a, b, label)] + [(None, 0.0, 1.0, "x"), (1.0, float("nan"), 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, one double, label string").repartition(5)
    found = {r["feature"]: r for r in trees.best_exact_splits(df, "label", ["a", "b", "one"], ranges).collect()}
    assert set(found) == {"a", "b"}  # a constant has no threshold

    def gini(part):
        _, n = np.unique(part, return_counts=True)
        return len(part) - (n * n).sum() / len(part)

    for name, column in (("a", 0), ("b", 1)):
        kept = [(r[column], r[3]) for r in rows if r[column] is not None and r[column] == r[column] and r[3] is not None]
        v, c = np.array([x for x, _ in kept]), np.array([x for _, x in kept])
        values = np.unique(v)
        scores = [(round((gini(c[v <= t]) + gini(c[v > t])) / len(v), 9), t, (t + u) / 2) for t, u in zip(values, values[1:])]
        best = min(scores)
        assert np.isclose(found[name]["gini"], best[0], atol=1e-6) and np.isclose(found[name]["threshold"], best[2], atol=1e-6)
        assert found[name]["n_left"] == (v <= best[1]).sum() and found[name]["n_right"] == (v > best[1]).sum()


def test_itemsets_against_brute_force(spark):
    rng = np.random.default_rng(8)
    names = ["a", "b", "c", "d", "e"]
    given = rng.random((400, 5)) < [0.5, 0.4, 0.3, 0.2, 0.05]
    df = spark.createDataFrame([tuple(bool(v) for v in r) for r in given], ", ".join(f"{n} boolean" for n in names)).repartition(3)
    sets, rules = association.frequent_itemsets(df, names, 0.02, size=4)
    want = {}
    for size in range(1, 5):
        for chosen in combinations(range(5), size):
            n = int(given[:, chosen].all(axis=1).sum())
            if n >= np.ceil(0.02 * 400):
                want[tuple(names[i] for i in chosen)] = n
    assert {tuple(r["items"]): r["n"] for r in sets.collect()} == want
    found = {(tuple(r["antecedent"]), r["consequent"]): r for r in rules.collect()}
    assert set(found) == {(tuple(x for x in s if x != c), c) for s in want if len(s) > 1 for c in s}
    for (side, c), r in found.items():
        whole = want[tuple(sorted((*side, c)))]
        assert r["n"] == whole and np.isclose(r["confidence"], whole / want[side], atol=1e-6)
        assert np.isclose(r["lift"], whole * 400 / (want[side] * want[c,]), atol=1e-6)
    none, no_rules = association.frequent_itemsets(df.limit(0), names, 0.1)
    assert none.count() == no_rules.count() == 0


def test_bad_lines_are_counted(spark, tmp_path):
    lines = ['1,2.5,"a, b"', "2,x,plain", "3,4.5", "4,5.5,c,more", '"5",6.5,"say ""so"""', "", "6,7.5,"]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    specs = [FieldSpec("id", "whole"), FieldSpec("v", "double"), FieldSpec("t", "text")]
    rows, bad = read_csv_checked(spark, str(tmp_path / "in.csv"), specs)
    assert sorted(map(tuple, rows.collect())) == [(1, 2.5, "a, b"), (2, None, "plain"), (5, 6.5, 'say "so"'), (6, 7.5, None)]
    assert sorted(map(tuple, bad.collect())) == [("3,4.5", 2), ("4,5.5,c,more", 3)]
    assert rows.select("id").count() == 4  # also when a plan reads one column


def test_merged_sketches(spark):
    df = spark.range(30000).select((F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("kind"), (F.col("id") % 4000).alias("user"),
                                   F.when(F.col("id") % 11 > 0, F.sqrt("id")).alias("v"))
    users = profiling.merged_distinct(profiling.distinct_sketches(df, "user", ["kind", "day"]), ["kind"])
    assert all(abs(r["n_distinct"] - 2000) <= 60 for r in users.collect())
    found = quantiles.merged_quantiles(quantiles.quantile_sketches(df, "v", ["kind", "day"]), ["kind"], [0.1, 0.5])
    for r in found.collect():
        values = np.array([x["v"] for x in df.filter((F.col("kind") == r["kind"]) & F.col("v").isNotNull()).collect()])
        assert r["n"] == len(values) and abs((values <= r["value"]).mean() - r["prob"]) <= 0.01


def test_linear_silhouette(spark):
    x, labels = _RNG.normal(size=(90, 3)), ["a"] * 40 + ["b"] * 49 + ["alone"]
    df = spark.createDataFrame([(p.tolist(), c) for p, c in zip(x, labels)] + [(x[0].tolist(), None)], "x array<double>, c string")
    squares = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    at = np.array(labels)
    scores = []
    for i in range(90):
        means = {c: squares[i, at == c].sum() / max((at == c).sum() - (c == at[i]), 1) for c in set(labels)}
        a, b = means.pop(at[i]), min(means.values())
        scores.append(0.0 if labels[i] == "alone" else 1 - a / b if a < b else b / a - 1)
    scores[-1] = 1.0  # a cluster of one is at no distance from itself
    assert np.isclose(clustering.linear_silhouette(df, "x", "c"), np.mean(scores), atol=1e-9) or np.isclose(
        clustering.linear_silhouette(df, "x", "c"), np.mean([*scores[:-1], 0.0]), atol=1e-9)
    assert clustering.linear_silhouette(df.filter("c = 'a'"), "x", "c") is None


def test_bernoulli_strata(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 3 == 0, "some").otherwise("most").alias("s"))
    n = {r["s"]: r["count"] for r in sampling.bernoulli_sample(df, "s", 1500).groupBy("s").count().collect()}
    assert n["rare"] == 200 and all(abs(n[s] - 500) <= 5 * 500**0.5 for s in ("some", "most"))


def test_a_block_travels_once_to_a_group(spark, monkeypatch):
    """Groups of many blocks get fewer copies of the blocks, and the neighbours are the same."""
    x = np.random.default_rng(8).normal(size=(900, 4))
    visits, sent = neighbours._visits, {}
    for size in (1, 10_000):
        def grouped(packs, _, size=size):
            found = visits(packs, size)
            sent[size] = found.count()
            return found

        monkeypatch.setattr(neighbours, "_visits", grouped)
        edges = nearest_neighbours(_frame(spark, np.arange(len(x)), x), "id", "x", 6, leaf_rows=30)
        assert sorted((r["id"], r["neighbor"], r["rank"], r["distance"]) for r in edges.collect()) == _brute(np.arange(len(x)), x, 6)
    assert sent[10_000] < sent[1] / 2


def test_the_first_bound_sorts_no_whole_row(monkeypatch):
    """Of a large block only the minima of runs are put in order, and the neighbours are exact."""
    x = np.random.default_rng(9).normal(size=(2_000, 3))
    ids = neighbours.pa.ListArray.from_arrays(
        neighbours.pa.array(np.arange(len(x) + 1), neighbours.pa.int32()), neighbours.pa.array(np.arange(len(x))))
    widths, partition = [], np.partition
    monkeypatch.setattr(neighbours.np, "partition", lambda a, *args, **options: widths.append(a.shape[1]) or partition(a, *args, **options))
    search = neighbours.Search(x, 7)
    search.meet(x, ids, np.arange(len(x)), x.mean(axis=0), float("inf"))
    rows, distance, found = search.result()
    assert widths and max(widths) <= len(x) // neighbours._RUN
    squares = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    assert np.allclose(np.sqrt(np.sort(squares, axis=1)[:, :7]).ravel(), distance)
    assert (found.to_numpy().reshape(-1, 7) == np.argsort(squares, axis=1, kind="stable")[:, :7]).all()


def test_codes_of_a_long_column_are_not_sent_with_those_of_a_short_one(spark, monkeypatch):
    monkeypatch.setattr(encoding, "FEW_VALUES", 10)
    df = spark.range(400).select(F.col("id").cast("string").alias("long"), (F.col("id") % 3).cast("string").alias("short"))
    labels = encoding.fit_labels(df, ["long", "short"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if the labels were large
    try:
        plan = encoding.apply_labels(df, labels, ["short", "long"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1


@pytest.mark.parametrize("partitions", [1, 7])
def test_label_codes_run_on_over_tasks(spark, partitions):
    df = spark.range(3000).select(
        F.concat(F.lit("v"), F.col("id") % 977).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 2).cast("string").alias("b"))
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        labels = encoding.fit_labels(df, ["a", "b"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {("a", v): i for i, v in enumerate(sorted(f"v{i}" for i in range(977)))} | {("b", v): i for i, v in enumerate(["0", "1", "Unknown"])}
    assert {(r["column"], r["value"]): r["code"] for r in labels} == want and len(labels) == len(want)


def test_ranked_rows_are_shuffled_once(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("s"))
    ranked = ranking.stratified_rank(df, ["s"], ["id"], 2000, "rank")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_wide_table_is_compiled(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    raw = spark.range(10).select(*[F.concat(F.lit("0"), F.col("id")).alias(f"c{i}") for i in range(60)])
    typed = coerce(raw, [FieldSpec(f"c{i}", "double") for i in range(60)])
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # HotSpot interprets longer methods
    assert [list(r) for r in typed.orderBy("c0").collect()] == [[float(i)] * 60 for i in range(10)]


def test_points_are_compared_with_few_runs_of_a_block(monkeypatch):
    """Boxes of runs rule out most of a block that a ball does not, and the neighbours are exact."""
    rng = np.random.default_rng(21)
    x = rng.random((6_000, 3))
    halves, cells, shortlist = [np.arange(0, 6_000, 2), np.arange(1, 6_000, 2)], [], neighbours.Search._shortlist
    runs = [neighbours.Cuts(x[at], neighbours._BOX_ROWS).leaf(x[at]) for at in halves]
    order = [np.argsort(run, kind="stable") for run in runs]
    blocks = [(x[at[o]], pa.array([[i] for i in at[o]]), at[o], x[at].mean(axis=0), 2.0, run[o]) for at, o, run in zip(halves, order, runs, strict=True)]
    search = neighbours.Search(blocks[0][0], 7, blocks[0][5])
    search.meet(*blocks[0])
    monkeypatch.setattr(neighbours.Search, "_shortlist", lambda self, at, right, *a: (cells.append(len(at) * right.shape[1]), shortlist(self, at, right, *a))[1])
    search.meet(*blocks[1])
    assert sum(cells) < 0.3 * 3_000 * 3_000
    rows, distance, found = search.result()
    squares = ((blocks[0][0][:, None, :] - x[None]) ** 2).sum(axis=2)
    assert np.allclose(np.sqrt(np.sort(squares, axis=1)[:, :7]).ravel(), distance)
    assert (found.to_numpy().reshape(-1, 7) == np.argsort(squares, axis=1, kind="stable")[:, :7]).all()


@pytest.mark.parametrize("values", [[0.0], [0.0, 1.0], [-2.0, 0.5, 0.5, 0.5, 0.5, 1e300]])
def test_cuts_part_points_but_not_equal_ones(values):
    x = np.asarray(values)[np.random.default_rng(22).integers(0, len(values), (500, 2))]
    leaf = neighbours.Cuts(x, 20).leaf(x)
    kinds = {tuple(point): set(leaf[(x == point).all(axis=1)]) for point in np.unique(x, axis=0)}
    assert all(len(leaves) == 1 for leaves in kinds.values())
    assert len(set(leaf)) == len({leaf for leaves in kinds.values() for leaf in leaves}) and len(set(leaf)) >= min(len(kinds), 2)
    assert (neighbours.Cuts(x[:0], 20).leaf(x) == 0).all()
