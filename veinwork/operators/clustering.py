"""k-means, cluster quality, profiles, centroid distances and projection."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil, sqrt
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinwork.functions.hashing import DEFAULT_SEED
from veinwork.operators.neighbours import _PIECE_CELLS, _nearest_pivot, matrix
from veinwork.operators.outliers import flag_above_quantile
from veinwork.operators.shape import col, drop_null
from veinwork.session import durable

MAX_ITERATIONS = 300
TOLERANCE = 1e-4
# Starts of one fit (each by MLlib's k-means||), of each k of a sweep, and how many run at once.
RESTARTS = 4
SWEEP_RESTARTS = 2
AT_ONCE = 2
CLUSTERS = 5
REGIONS = 8
SWEEP = tuple(range(2, 11))
# Doubles that a cached partition of a fit may hold, and what a cached row takes beside its features.
PART_VALUES = 64_000_000
ROW_VALUES = 16
# Rows of a block, and of a slice, that a task of the exact silhouette compares.
BLOCK_ROWS = 32_768
# Distances that are held together, and points of a block that they are taken to.
CACHED_CELLS = 65_536
COLUMNS = 512


@dataclass(frozen=True)
class Clusters:
    """Fitted centers, and the sum of squared distances to the nearest of them."""

    centers: list[list[float]]
    inertia: float

    def by_id(self) -> dict[int, list[float]]:
        return dict(enumerate(self.centers))


def _mean_variance(df: DataFrame, vector: Column, *weight: Column) -> float:
    row = df.select(Summarizer.variance(vector, *weight)).first()
    return float(np.mean(row[0].toArray())) if row and row[0] is not None else 0.0


def _mllib(
    vectors: DataFrame, starts: Sequence[tuple[int, int]], weight: str | None, parallelism: int,
    max_iterations: int, still: float,
) -> list[tuple[float, np.ndarray]]:
    """Cost and centers of MLlib's fit for each (k, seed), over all rows, `parallelism` of them at once,
    each of which caches its own decoded rows; without iterations the centers of k-means||."""
    options = {"weightCol": weight} if weight else {}
    # Cached rows are many times the size of the file, so that a scan of few bytes may still be a
    # partition of many rows.
    rows, size = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    parts, allowed = vectors.rdd.getNumPartitions(), max(1, PART_VALUES // (size + ROW_VALUES))
    dealt = vectors.repartition(ceil(rows / allowed)) if rows > allowed * parts else vectors
    dealt = dealt.select(array_to_vector("x").alias("vector"), *([weight] if weight else []))

    def fit(start: tuple[int, int]) -> tuple[float, np.ndarray]:
        k, seed = start
        model = KMeans(
            k=k, seed=seed, maxIter=max_iterations, tol=sqrt(still / k), featuresCol="vector", **options).fit(dealt)
        return model.summary.trainingCost, np.array([[float(v) for v in c] for c in model.clusterCenters()])

    with ThreadPool(max(1, min(parallelism, len(starts)))) as pool:
        return pool.map(inheritable_thread_target(vectors.sparkSession)(fit), starts)


def _totals(tables: Sequence[np.ndarray], weighted: bool):
    """Of a task's rows, for each table of centers and each of them: the weight and the sum of the rows
    nearest to it, and with the first of a table the squared distances of all; one run of numbers."""
    centers = np.concatenate(tables)
    starts = np.cumsum([0, *[len(t) for t in tables]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = centers.mean(axis=0)
        near = centers - middle
        half = 0.5 * (near * near).sum(axis=1)[:, None]
        found = np.zeros((len(centers), near.shape[1] + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            moved = x - middle
            squares = (moved * moved).sum(axis=1)
            weight = batch.column("weight").to_numpy() if weighted else np.ones(len(x))
            affinity = near @ moved.T - half
            member = np.zeros(affinity.shape)
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                best, at = affinity[start].copy(), np.full(len(x), start)
                for j in range(start + 1, end):  # the first of equal centers
                    at[affinity[j] > best] = j
                    np.maximum(best, affinity[j], out=best)
                member[at, np.arange(len(x))] = weight
                found[start, -1] += weight @ np.maximum(squares - 2.0 * best, 0.0)
            found[:, 0] += member.sum(axis=1)
            found[:, 1:-1] += member @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(found.size), pa.int32()), pa.array(found.ravel())], names=["place", "value"])

    return run


def _fit_all(
    vectors: DataFrame, ks: Sequence[int], restarts: int, max_iterations: int, seed: int, parallelism: int,
    weight: str | None = None, stored: bool = False,
) -> dict[int, Clusters]:
    """For each k the best of its starts, on one stored table (x, and weight if given).

    MLlib fits a single k. Of several it seeds each start, and from there on all starts of all k
    move together: a pass over the rows serves every start that has not settled, so there are as
    many passes as the slowest start has steps. A start moves and stops as MLlib's does.
    """
    vectors = vectors if stored else durable(vectors)
    if vectors.isEmpty():
        raise ValueError("no rows to cluster")
    # The centers may still move by a share of the mean variance of the features, all taken
    # together, so that the stop does not depend on the unit of the features.
    still = TOLERANCE * _mean_variance(vectors, array_to_vector("x"), *([F.col(weight)] if weight else []))
    starts = [(k, seed + i) for k in ks for i in range(restarts)]
    alone = len(set(ks)) == 1
    fitted = _mllib(vectors, starts, weight, parallelism, max_iterations if alone else 0, still)
    cost, centers = [f[0] for f in fitted], [f[1] for f in fitted]
    moving = [] if alone else list(range(len(starts)))
    for _ in range(max_iterations):
        if not moving:
            break
        tables = [centers[m] for m in moving]
        size = tables[0].shape[1] + 2
        sums = vectors.mapInArrow(_totals(tables, weight is not None), "place int, value double").groupBy("place").agg(
            F.sum("value").alias("value")).collect()  # a row per number of a center
        flat = np.zeros(size * sum(len(t) for t in tables))
        flat[[r["place"] for r in sums]] = [r["value"] for r in sums]
        parts = np.split(flat.reshape(-1, size), np.cumsum([len(t) for t in tables])[:-1])
        left = []
        for m, part in zip(moving, parts, strict=True):
            used = part[:, 0] > 0
            moved = centers[m].copy()  # a center without rows stays
            moved[used] = part[used, 1:-1] / part[used, :1]
            if (((moved - centers[m]) ** 2).sum(axis=1) > still / starts[m][0]).any():
                left.append(m)
            centers[m], cost[m] = moved, float(part[:, -1].sum())
        moving = left
    best = {}
    for k in ks:
        value, _, table = min((cost[m], s, centers[m].tolist()) for m, (own, s) in enumerate(starts) if own == k)
        best[k] = Clusters(table, value)
    return best


def fit_kmeans(
    df: DataFrame,
    features: str,
    k: int = CLUSTERS,
    restarts: int = RESTARTS,
    max_iterations: int = MAX_ITERATIONS,
    seed: int = DEFAULT_SEED,
    parallelism: int = AT_ONCE,
) -> Clusters:
    """k-means of lowest inertia over `restarts` seeds."""
    vectors = df.select(col(features).cast(T.ArrayType(T.DoubleType())).alias("x"))
    return _fit_all(vectors, [k], restarts, max_iterations, seed, parallelism)[k]


def fit_regions(
    df: DataFrame, latitude: str, longitude: str, regions: int = REGIONS,
    restarts: int = RESTARTS, seed: int = DEFAULT_SEED, parallelism: int = AT_ONCE,
) -> Clusters:
    """k-means over coordinates alone, on all rows. Places repeat, so each is counted once and
    then weighs as many rows as it has; all restarts read the counted places."""
    coordinates = df.select(col(latitude).cast("double").alias("a"), col(longitude).cast("double").alias("b"))
    places = (
        drop_null(coordinates).groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .select(F.array("a", "b").alias("x"), "weight")
    )
    return _fit_all(places, [regions], restarts, MAX_ITERATIONS, seed, parallelism, "weight")[regions]


def assign_regions(
    df: DataFrame, regions: Clusters, latitude: str, longitude: str, out: str = "region"
) -> DataFrame:
    """Region of each row; null coordinates have none."""
    a, b = col(latitude).cast("double"), col(longitude).cast("double")
    near = F.array_min(F.array(*[
        F.struct(((a - F.lit(x)) * (a - F.lit(x)) + (b - F.lit(y)) * (b - F.lit(y))).alias("d"),
                 F.lit(i).alias("region"))
        for i, (x, y) in enumerate(regions.centers)
    ]))
    return df.withColumn(out, F.when(a.isNotNull() & b.isNotNull(), near["region"]))


def assign_many(df: DataFrame, features: str, models: dict[int, Clusters]) -> DataFrame:
    """Add `k<k>`, the cluster under each model, all from one read of the features."""
    names = sorted(models)
    tables = [np.array(models[k].centers) for k in names]

    @F.pandas_udf("array<int>")
    def codes(x: pd.Series) -> pd.Series:
        points = matrix(x) if len(x) else np.zeros((0, tables[0].shape[1]))
        found = [_nearest_pivot(points, t) for t in tables] if len(x) else []
        return pd.Series(list(np.stack(found, axis=1).astype(np.int32)) if len(x) else [])

    array = col(features).cast(T.ArrayType(T.DoubleType()))
    coded = df.withColumn("_codes", codes(array))
    return coded.select(
        *[col(c) for c in df.columns], *[F.col("_codes")[i].alias(f"k{k}") for i, k in enumerate(names)])


def _nearest_udf(ids: Sequence[int], centroids: np.ndarray):
    @F.pandas_udf("cluster int, distance double")
    def nearest(x: pd.Series) -> pd.DataFrame:
        points = matrix(x) if len(x) else np.zeros((0, centroids.shape[1]))
        squares = np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        best = squares.argmin(axis=1)
        return pd.DataFrame({
            "cluster": np.asarray(ids, dtype=np.int32)[best],
            "distance": np.sqrt(squares[np.arange(len(best)), best]),
        })

    return nearest


def nearest_centroid(df: DataFrame, features: str, centroids: dict[int, Sequence[float]]) -> DataFrame:
    """Add `cluster` and `distance` of the closest centroid, the smaller id on ties."""
    ids = sorted(centroids)
    nearest = _nearest_udf(ids, np.array([centroids[i] for i in ids], dtype=float))
    array = col(features).cast(T.ArrayType(T.DoubleType()))
    return df.withColumn("_near", nearest(array)).select(
        *[col(c) for c in df.columns], F.col("_near.cluster").alias("cluster"),
        F.col("_near.distance").alias("distance"),
    )


def label_centroids(df: DataFrame, features: str, label: str) -> dict:
    """Mean vector of each label. One aggregate; a row per label reaches the driver."""
    vector = array_to_vector(col(features).cast(T.ArrayType(T.DoubleType())))
    rows = df.filter(col(label).isNotNull()).select(col(label).alias("label"), vector.alias("x")).groupBy("label").agg(
        Summarizer.mean(F.col("x")).alias("mean")).collect()
    return {r["label"]: r["mean"].toArray().tolist() for r in rows}


def inertia(df: DataFrame, features: str, centroids: dict[int, Sequence[float]]) -> DataFrame:
    near = nearest_centroid(df, features, centroids)
    return near.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("distance") * F.col("distance")), 6).alias("inertia")
    )


def centroid_outliers(
    df: DataFrame, features: str, centroids: dict[int, Sequence[float]], share: float = 0.01,
) -> DataFrame:
    """Distance to the nearest centroid, and whether it is above the 1 - share quantile."""
    near = nearest_centroid(df, features, centroids)
    return flag_above_quantile(near, "distance", share, "is_outlier")


def _own_distance(centroids: dict, label: Column, x: Column) -> Column:
    """Distance of each row to the centroid of its label."""
    labels = pd.Index(list(centroids))
    table = np.array(list(centroids.values()), dtype=float)

    @F.pandas_udf("double")
    def distance(own: pd.Series, points: pd.Series) -> pd.Series:
        if not len(points):
            return pd.Series([], dtype=float)
        gaps = matrix(points) - table[labels.get_indexer(own)]
        return pd.Series(np.sqrt((gaps * gaps).sum(axis=1)))

    return distance(label, x)


def davies_bouldin_value(df: DataFrame, features: str, label: str) -> float | None:
    centroids = label_centroids(df, features, label)
    array = col(features).cast(T.ArrayType(T.DoubleType()))
    spread = {
        r[0]: r[1]
        for r in df.filter(col(label).isNotNull()).groupBy(col(label))
        .agg(F.avg(_own_distance(centroids, col(label), array))).collect()  # a row per cluster
    }
    if len(spread) < 2:
        return None
    worst = []
    for i, a in centroids.items():
        ratios = [
            (spread[i] + spread[j]) / gap if (gap := sqrt(sum((u - v) ** 2 for u, v in zip(a, b)))) else 0.0
            for j, b in centroids.items() if j != i
        ]
        worst.append(max(ratios))
    return sum(worst) / len(worst)


def davies_bouldin(df: DataFrame, features: str, label: str) -> DataFrame:
    value = davies_bouldin_value(df, features, label)
    return df.sparkSession.createDataFrame([(value,)], "davies_bouldin double").select(
        F.round("davies_bouldin", 6).alias("davies_bouldin"))


def _cluster_sums(offsets: Sequence[int], width: int):
    """Of the rows of two groups, the sums of distances to the rows of each cluster in the other group;
    the two may be the same group."""

    def members(codes: np.ndarray) -> np.ndarray:
        member = np.zeros((len(codes), width))
        for i, start in enumerate(offsets):
            member[np.arange(len(codes)), start + codes[:, i]] = 1.0
        return member

    def sums(visitors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if visitors.empty or block.empty:
            return pd.DataFrame({"id": visitors["id"][:0], "codes": [], "sums": []})
        x, points = matrix(visitors["x"]), matrix(block["x"])
        same = pd.Index(block["id"]).get_indexer(visitors["id"])
        itself = visitors["low"].iloc[0] == visitors["high"].iloc[0]
        theirs, mine = members(np.stack(block["codes"].to_numpy())), members(np.stack(visitors["codes"].to_numpy()))
        sums, back = np.zeros((len(x), width)), np.zeros((len(points), width))
        # Squares by one product, as `neighbours.rough_squares`, in pieces that stay in a core's cache.
        middle = points.mean(axis=0)
        x, points = x - middle, points - middle
        left = np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))])
        right = np.ascontiguousarray(np.column_stack([-2.0 * points, np.ones(len(points)), (points * points).sum(axis=1)]).T)
        columns = min(len(points), COLUMNS)
        step = max(1, min(CACHED_CELLS, _PIECE_CELLS) // columns)
        piece = np.empty(step * columns)
        for first in range(0, len(points), columns):
            last = min(first + columns, len(points))
            across = np.ascontiguousarray(right[:, first:last])
            for start in range(0, len(x), step):
                end = min(start + step, len(x))
                own = same[start:end]
                squares = piece[:(end - start) * (last - first)].reshape(end - start, last - first)
                np.matmul(left[start:end], across, out=squares)
                np.maximum(squares, 0.0, out=squares)
                here = np.flatnonzero((own >= first) & (own < last))
                squares[here, own[here] - first] = 0.0
                np.sqrt(squares, out=squares)
                sums[start:end] += squares @ theirs[first:last]
                if not itself:
                    back[first:last] += squares.T @ mine[start:end]
        found = pd.DataFrame({"id": visitors["id"], "codes": visitors["codes"], "sums": list(sums)})
        if itself:
            return found
        return pd.concat([found, pd.DataFrame({"id": block["id"], "codes": block["codes"], "sums": list(back)})])

    return sums


def _blocks(total: int, parallel: int) -> int:
    """How many groups the rows are cut into. Every row goes to a task for each group, so these are as large
    as a task can hold, and only as many as keep the cores busy."""
    return max(1, ceil(total / BLOCK_ROWS), min(ceil(sqrt(2 * parallel)), ceil(total / 512)))


def silhouette_rows(df: DataFrame, id: str, features: str, labels: Sequence[str]) -> DataFrame:
    """`(id, labeling, silhouette)` by Euclidean distance, for several labelings at once.

    Every row needs its mean distance to every cluster, so the work is quadratic in the rows:
    meant for a sample. Groups of rows meet, each pair of groups once; what leaves a task is one sum
    per row and cluster. A row alone in its cluster scores 0, as does every row of a labeling with
    one cluster. Labels may be of any type that has a text form; a row that lacks one of the
    labels is left out.
    """
    spark = df.sparkSession
    id_type = dict(df.dtypes)[id]
    df = df.select(col(id), col(features), *[col(label).cast("string") for label in labels]).dropna(subset=list(labels))
    counts = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), col(label).alias("label")) for i, label in enumerate(labels)
    ]))).groupBy("i", "label").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per cluster
    sizes: list[dict[str, int]] = [{} for _ in labels]
    for r in sorted(counts, key=lambda r: (r["i"], r["label"])):
        sizes[r["i"]][r["label"]] = r["n"]
    offsets = [sum(len(s) for s in sizes[:i]) for i in range(len(labels))]
    width = sum(len(s) for s in sizes)
    total = sum(sizes[0].values())

    code = lambda i: F.array_position(
        F.array(*[F.lit(v) for v in sizes[i]]), col(labels[i])).cast("int") - 1
    groups = _blocks(total, spark.sparkContext.defaultParallelism)
    group = F.pmod(F.xxhash64(F.lit("group"), col(id)), F.lit(groups)).cast("int")
    dealt = df.select(
        col(id).alias("id"), col(features).cast(T.ArrayType(T.DoubleType())).alias("x"),
        F.array(*[code(i) for i in range(len(labels))]).alias("codes"), group.alias("own"))
    visitors = dealt.select("*", F.col("own").alias("low"), F.explode(F.sequence("own", F.lit(groups - 1))).alias("high"))
    blocks = dealt.select("*", F.explode(F.sequence(F.lit(0), "own")).alias("low"), F.col("own").alias("high"))
    partial = visitors.groupBy("low", "high").cogroup(blocks.groupBy("low", "high")).applyInPandas(
        _cluster_sums(offsets, width), f"id {id_type}, codes array<int>, sums array<double>"
    )
    sums = partial.groupBy("id").agg(
        F.first("codes").alias("codes"), F.array(*[F.sum(F.col("sums")[c]) for c in range(width)]).alias("sums")
    )
    records = []
    for i, label in enumerate(labels):
        n = F.array(*[F.lit(v) for v in sizes[i].values()])
        mine = F.col("codes")[i]
        part = F.slice("sums", offsets[i] + 1, len(sizes[i]))
        means = F.zip_with(part, n, lambda s, m: s / m)
        own = F.try_divide(part[mine], n[mine] - 1)
        other = F.array_min(F.filter(means, lambda m, j: j != mine))
        wide = F.greatest(own, other)
        score = F.when((n[mine] > 1) & other.isNotNull() & (wide > 0), (other - own) / wide).otherwise(F.lit(0.0))
        records.append(F.struct(F.lit(label).alias("labeling"), score.alias("silhouette")))
    return sums.select("id", F.inline(F.array(*records)))


def silhouette(df: DataFrame, id: str, features: str, labels: Sequence[str]) -> DataFrame:
    """`(labeling, silhouette)`: the mean over all rows."""
    return silhouette_rows(df, id, features, labels).groupBy("labeling").agg(
        F.round(F.avg("silhouette"), 6).alias("silhouette")
    )


def linear_silhouette(df: DataFrame, features: str, label: str) -> float | None:
    """Mean silhouette by squared Euclidean distance, of all rows: each cluster's size, vector sum and
    sum of squares give every row's mean distance to it, so the work is linear and a row per cluster
    is all that is shared. None with fewer than two clusters; rows without a label are left out."""
    given = df.filter(col(label).isNotNull())
    codes = durable(given.select(col(label).alias("label")).distinct().select(
        "label", F.monotonically_increasing_id().cast("double").alias("code")))
    if codes.count() < 2:
        return None
    vectored = given.select(col(label).alias("label"), array_to_vector(col(features).cast(T.ArrayType(T.DoubleType()))).alias("vector"))
    evaluator = ClusteringEvaluator(
        featuresCol="vector", predictionCol="code", metricName="silhouette", distanceMeasure="squaredEuclidean")
    # The evaluator reads the rows twice; the codes join them on the way, so that no copy is written.
    return evaluator.evaluate(vectored.join(codes, "label"))


def _label_sums(labels: Sequence[str], sizes: Sequence[int]):
    """Of a task's rows, for each cluster of each labeling: its rows, the sum of their squares and of their
    vectors; one run of numbers."""
    starts = np.cumsum([0, *sizes])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            if found is None:
                found = np.zeros((starts[-1], x.shape[1] + 2))
            wide = np.column_stack([np.ones(len(x)), (x * x).sum(axis=1), x])
            member = np.zeros((starts[-1], len(x)))
            for label, start in zip(labels, starts):
                member[start + batch.column(label).to_numpy(), np.arange(len(x))] = 1.0
            found += member @ wide
        if found is not None:
            yield _numbers(found)

    return run


def _label_scores(labels: Sequence[str], sums: Sequence[np.ndarray]):
    """Of a task's rows, for each cluster of each labeling: the sum of the rows' silhouettes by squared
    distances, and of their distances to the cluster's mean."""
    starts = np.cumsum([0, *[len(s) for s in sums]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((starts[-1], 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            squares, rows = (x * x).sum(axis=1), np.arange(len(x))
            for label, start, table in zip(labels, starts, sums):
                own = batch.column(label).to_numpy()
                n = table[:, 0]
                means = table[:, 2:] / np.maximum(n, 1.0)[:, None]
                far = squares[:, None] + table[:, 1] / np.maximum(n, 1.0) - 2.0 * (x @ means.T)
                far[:, n == 0] = np.inf
                mine = far[rows, own] * n[own] / np.maximum(n[own] - 1.0, 1.0)
                far[rows, own] = np.inf
                other = far.min(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.where(mine < other, 1.0 - mine / other, np.where(mine > other, other / mine - 1.0, 0.0))
                score[n[own] <= 1] = 0.0
                gaps = x - means[own]
                place = slice(start, start + len(table))
                found[place, 0] += np.bincount(own, score, len(table))
                found[place, 1] += np.bincount(own, np.sqrt((gaps * gaps).sum(axis=1)), len(table))
        yield _numbers(found)

    return run


def _numbers(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(found.size), pa.int32()), pa.array(found.ravel())], names=["place", "value"])


def linear_scores(df: DataFrame, features: str, labels: dict[str, int]) -> dict[str, tuple[float | None, float | None]]:
    """For each labeling, whose clusters are numbers below the given one, what `linear_silhouette` and
    `davies_bouldin_value` say of it. All labelings share two passes over the rows."""
    names, sizes = list(labels), list(labels.values())
    rows = df.select(col(features).cast(T.ArrayType(T.DoubleType())).alias("x"), *[col(n) for n in names])

    def summed(counter) -> np.ndarray:
        found = rows.mapInArrow(counter, "place int, value double").groupBy("place").agg(
            F.sum("value").alias("value")).collect()  # a row per number of a cluster
        flat = np.zeros(len(found))
        flat[[r["place"] for r in found]] = [r["value"] for r in found]
        return flat

    flat = summed(_label_sums(names, sizes))
    if not len(flat):
        return dict.fromkeys(names, (None, None))
    sums = np.split(flat.reshape(sum(sizes), -1), np.cumsum(sizes)[:-1])
    scores = np.split(summed(_label_scores(names, sums)).reshape(-1, 2), np.cumsum(sizes)[:-1])
    out: dict[str, tuple[float | None, float | None]] = {}
    for name, table, score in zip(names, sums, scores, strict=True):
        used = table[:, 0] > 0
        n, means = table[used, 0], table[used, 2:] / table[used, :1]
        if len(n) < 2:
            out[name] = (None, None)
            continue
        spread = score[used, 1] / n
        gap = np.sqrt(((means[:, None] - means[None]) ** 2).sum(axis=2))
        ratio = np.divide(spread[:, None] + spread, gap, out=np.zeros_like(gap), where=gap > 0)
        np.fill_diagonal(ratio, -np.inf)
        out[name] = (float(score[:, 0].sum() / n.sum()), float(ratio.max(axis=1).mean()))
    return out


def k_sweep(
    df: DataFrame,
    id: str,
    features: str,
    ks: Sequence[int] = SWEEP,
    restarts: int = SWEEP_RESTARTS,
    max_iterations: int = MAX_ITERATIONS,
    seed: int = DEFAULT_SEED,
    judged: DataFrame | None = None,
) -> tuple[DataFrame, dict[int, Clusters]]:
    """`(k, inertia, silhouette, linear_silhouette, davies_bouldin)` with the rank of k by the silhouette
    and by Davies-Bouldin, and the models.

    All of it is of all rows, but for the exact silhouette, whose work is quadratic: `judged` may name
    the rows (a column `id`) that it is taken over. A score that does not exist (all rows in one
    cluster) is null and ranks last.
    """
    vectors = durable(df.select(col(features).cast(T.ArrayType(T.DoubleType())).alias("x")))
    models = _fit_all(vectors, ks, restarts, max_iterations, seed, AT_ONCE, stored=True)
    named = durable(assign_many(df.select(col(id), col(features)), features, models))
    seen = named if judged is None else durable(named.join(judged.select(col(id)), id))
    scores = {
        r["labeling"]: r["silhouette"]
        for r in silhouette(seen, id, features, [f"k{k}" for k in sorted(ks)]).collect()
    }
    linear = linear_scores(named, features, {f"k{k}": len(models[k].centers) for k in sorted(ks)})
    rows = [(k, models[k].inertia, scores[f"k{k}"], *linear[f"k{k}"]) for k in sorted(ks)]
    by_silhouette = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0.0)))
    by_db = sorted(rows, key=lambda r: (r[4] is None, r[4] or 0.0))
    ranked = [
        (*r, by_silhouette.index(r) + 1, by_db.index(r) + 1) for r in rows
    ]
    table = df.sparkSession.createDataFrame(
        ranked,
        "k int, inertia double, silhouette double, linear_silhouette double, davies_bouldin double, "
        "silhouette_rank int, davies_bouldin_rank int",
    )
    return table, models


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    counts = df.groupBy(col(cluster)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()), 6))


def cluster_profile(
    df: DataFrame,
    cluster: str,
    modes: Sequence[str] = (),
    rates: Sequence[str] = (),
    means: Sequence[str] = (),
) -> DataFrame:
    """Size, share, most common values (the smallest on ties), flag rates and means.

    Modes are for columns of few values, such as the hour.
    """
    one = df.groupBy(col(cluster)).agg(
        F.count(F.lit(1)).alias("size"),
        *[F.mode(col(m), True).alias(f"{m}_mode") for m in modes],
        *[F.round(F.avg(col(r).cast("int")) * 100.0, 6).alias(f"{r}_pct") for r in rates],
        *[F.round(F.avg(col(m)), 6).alias(f"{m}_mean") for m in means],
    )
    return one.withColumn("pct", F.round(F.col("size") * 100.0 / F.sum("size").over(W.partitionBy()), 6))


def cluster_top_classes(df: DataFrame, cluster: str, label: str, n: int = 3) -> DataFrame:
    """The `n` largest classes of each cluster."""
    order = W.partitionBy(col(cluster)).orderBy(F.desc("n"), col(label))
    return (
        df.filter(col(label).isNotNull()).groupBy(col(cluster), col(label)).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    )


def project(df: DataFrame, id: str, features: str, components: int = 2) -> tuple[DataFrame, list[float]]:
    """Principal components of already centred features, and their explained variance ratios.

    A component's sign is fixed so that its largest loading is positive.
    """
    vectored = df.select(col(id), array_to_vector(col(features)).alias("vector"))
    model = PCA(k=components, inputCol="vector", outputCol="projected").fit(vectored)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(components)]
    array = vector_to_array("projected")
    placed = model.transform(vectored).select(
        col(id), *[(array[i] * F.lit(s)).alias(f"pc{i + 1}") for i, s in enumerate(signs)]
    )
    return placed, [float(v) for v in model.explainedVariance]
