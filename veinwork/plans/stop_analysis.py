"""The analyses of a traffic-stop table: profile, prepare, classify, cluster, screen for outliers.

Each takes the typed table (see `veinwork.sources.stops`) and returns named result tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.functions import binning, temporal
from veinwork.functions.hashing import DEFAULT_SEED, DIGEST, digest
from veinwork.operators import (
    association, cleaning, clustering, encoding, outliers, profiling, quantiles, sampling, trees,
)
from veinwork.operators.neighbours import nearest_neighbours
from veinwork.operators.shape import col, columns_by_kind, drop_null, feature_array, project
from veinwork.session import discard, durable

# The columns each analysis reads and models.
TARGET = "Violation Type"
CALENDAR = ("Hour", "Month", "DayOfWeek", "IsWeekend")
CATEGORIES = ("VehicleType", "SubAgency", "Gender", "Race", "TimeOfDay")
CLASSIFY_FLAGS = (
    "Accident", "Personal Injury", "Property Damage", "Fatal", "Belts", "Alcohol", "Work Zone",
    "Commercial License", "Commercial Vehicle", "HAZMAT", "Contributed To Accident",
)
CLUSTER_FLAGS = (
    "Accident", "Personal Injury", "Property Damage", "Fatal", "Alcohol", "Work Zone",
    "Commercial Vehicle", "HAZMAT",
)
OUTLIER_FLAGS = (
    "Accident", "Personal Injury", "Property Damage", "Fatal", "Alcohol", "Work Zone",
    "Commercial Vehicle", "HAZMAT", "Belts", "Contributed To Accident",
)
RULE_FLAGS = (
    "Accident", "Personal Injury", "Property Damage", "Fatal", "Alcohol", "Work Zone", "Belts",
    "Commercial Vehicle", "HAZMAT",
)
OUTLIER_NUMBERS = ("Latitude", "Longitude", *CALENDAR, "VehicleAge")
BASES = ("Date Of Stop", "Time Of Stop", "Latitude", "Longitude", "Year")
LABELS = ("SeqID", "Location", TARGET)
MIN_CLASS_ROWS = 1000
ONE_HOT = (*CATEGORIES, "VehicleAge_Binned", "Hour_Binned")
PREPARED = (
    "Date Of Stop", "Time Of Stop", "Violation Type", "Charge", "VehicleType", "Year", "Make", "Color",
    "Race", "Gender", "Driver State", "Belts", "Alcohol", "Work Zone", "Property Damage",
    "Personal Injury", "Search Outcome", "Latitude", "Longitude", "State", "Agency",
)
UNKNOWN_FILLED = (
    "Make", "Color", "Model", "Driver State", "State", "DL State", "VehicleType", "Race", "Gender",
    "Violation Type", "Charge", "Location", "Search Outcome",
)


def _encoded(names: Sequence[str]) -> list[str]:
    return [f"{n}_encoded" for n in names]


def with_calendar(df: DataFrame) -> DataFrame:
    """Hour, month, weekday, weekend and band of the day."""
    day, hour = col("Date Of Stop"), temporal.hour_of_clock(col("Time Of Stop"))
    return df.select(
        "*", hour.alias("Hour"), F.month(day).alias("Month"), temporal.day_of_week(day).alias("DayOfWeek"),
        temporal.weekend_flag(day).alias("IsWeekend"), temporal.day_band(hour).alias("TimeOfDay"),
    )


def profile(stops: DataFrame) -> dict[str, DataFrame]:
    """Shape, distributions, duplicates and gaps of the whole table."""
    kinds = columns_by_kind(stops, exclude=["SeqID"])
    return {
        "shape": profiling.table_shape(stops),
        "numbers": profiling.describe_numeric(stops, kinds["numeric"]),
        "flags": profiling.boolean_counts(stops, kinds["boolean"]),
        "categories": profiling.categorical_summary(stops, kinds["categorical"]),
        "duplicates": profiling.duplicate_count(stops, ["SeqID"]),
        "missing": profiling.missing_report(stops),
    }


def classify(
    stops: DataFrame,
    keys: Sequence[str],
    fit_rows: int | None = None,
    min_class_rows: int = MIN_CLASS_ROWS,
    seed: int = DEFAULT_SEED,
) -> dict[str, DataFrame]:
    """Decision tree for the violation type. `keys` name a row uniquely.

    Trees are fitted on all of their training rows, or, if the caller gives `fit_rows`, on stratified
    samples of about so many; accuracy, confusion and the folds of the cross-validation are of all rows.
    """
    numbers = [*CALENDAR, "Latitude", "Longitude", "VehicleAge"]
    chosen = project(stops, [*dict.fromkeys([*keys, *BASES, TARGET, *CLASSIFY_FLAGS, *CATEGORIES])])
    labelled = drop_null(chosen, [TARGET])
    frequent = cleaning.frequent_classes(labelled, TARGET, min_class_rows)
    age = temporal.years_since(col("Year"), 2024, missing="zero")
    # Written once: the label fit and the coding each read a few of its columns. The digest stands for the keys.
    featured = durable(project(with_calendar(frequent).withColumn("VehicleAge", age).withColumn(DIGEST, digest(keys, seed)), [
        DIGEST, TARGET, *numbers, *CLASSIFY_FLAGS, *CATEGORIES]))
    labels = encoding.fit_labels(featured, CATEGORIES)
    coded = encoding.apply_labels(featured, labels, CATEGORIES, unseen=0)
    names = [*numbers, *CLASSIFY_FLAGS, *_encoded(CATEGORIES)]
    matrix = encoding.feature_matrix(coded, [DIGEST, TARGET], numbers, CLASSIFY_FLAGS, _encoded(CATEGORIES))
    if fit_rows is None:
        splits = trees.candidate_splits(matrix, names)
        rows = durable(trees.code_features(matrix, splits))
    else:
        rows = durable(matrix)
    discard(featured)
    parted = sampling.train_test_split(rows, [TARGET], [DIGEST], seed=seed)
    if fit_rows is None:
        dealt = durable(sampling.stratified_folds(parted, [TARGET], [DIGEST], seed=seed).drop(DIGEST))
        discard(rows)
        parts = dealt
        tree, folds = _fitted_on_all(dealt, splits)
        predicted = parts.withColumn("predicted", trees.over_codes(tree, splits).predict())
    else:
        parts = durable(parted)
        fitted = durable(sampling.stratified_sample(parts.filter("split = 'train'").drop("split"), [TARGET], [DIGEST], fit_rows, seed))
        tree = trees.fit_tree(fitted, TARGET, names, seed=seed)
        folds = trees.cross_validate(rows, TARGET, names, [DIGEST], seed=seed, fit_rows=fit_rows)
        predicted = parts.withColumn("predicted", tree.predict())
    test = predicted.filter("split = 'test'")
    hit = (col(TARGET) == F.col("predicted")).cast("double")
    return {
        "classes": profiling.class_distribution(parts, TARGET, "split"),
        "accuracy": predicted.groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg(hit), 6).alias("accuracy")),
        "confusion": trees.confusion_matrix(test, TARGET, "predicted"),
        "folds": folds,
        "validation": trees.validation_summary(folds),
        "importance": trees.importance_table(parts, tree),
        "rules": trees.rule_table(parts, tree),
    }


def _fitted_on_all(dealt: DataFrame, splits: dict[str, list[float]]) -> tuple[trees.Tree, DataFrame]:
    """The tree of the training split, and `(fold, n, accuracy)` of trees of the other folds, all fitted
    together on all of their rows."""
    numbers = [r["fold"] for r in dealt.select("fold").distinct().orderBy("fold").collect()]  # a row per fold
    parts = {"in_train": F.col("split") == "train", **{f"out_of_{i}": F.col("fold") != i for i in numbers}}
    rows = dealt.withColumns(parts)
    classes = [r["c"] for r in dealt.select(col(TARGET).cast("string").alias("c")).distinct().orderBy("c").collect()]
    first, *others = trees.fit_trees(rows, TARGET, splits, list(parts), classes)
    guess = F
    for i, tree in zip(numbers, others, strict=True):
        guess = guess.when(F.col("fold") == i, trees.over_codes(tree, splits).predict())
    hit = (col(TARGET).cast("string") == (guess if numbers else F.lit(None))).cast("double")
    scores = durable(dealt.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")))
    return first, scores.orderBy("fold")


def cluster(
    stops: DataFrame,
    keys: Sequence[str],
    judged_rows: int = sampling.SAMPLE_ROWS,
    k: int = clustering.CLUSTERS,
    ks: Sequence[int] = clustering.SWEEP,
    restarts: int = clustering.SWEEP_RESTARTS,
    seed: int = DEFAULT_SEED,
) -> dict[str, DataFrame]:
    """k-means of all rows, fitted and compared on all of them. Only the exact silhouette of the
    sweep is taken over a stratified sample of about `judged_rows`. `ks` must hold the chosen `k`."""
    if k not in ks:
        raise ValueError(f"k={k} is not among the swept {list(ks)}")
    numbers = [*CALENDAR, "region", "VehicleAge"]
    chosen = project(stops, [*dict.fromkeys([*keys, *BASES, TARGET, *CLUSTER_FLAGS, *CATEGORIES])])
    placed = drop_null(chosen, ["Latitude", "Longitude"])
    featured = durable(with_calendar(placed).withColumn(
        "VehicleAge", temporal.years_since(col("Year"), 2025, missing="zero")))
    regions = clustering.fit_regions(featured, "Latitude", "Longitude", restarts=restarts, seed=seed)
    featured = clustering.assign_regions(featured, regions, "Latitude", "Longitude")
    labels = encoding.fit_labels(featured, CATEGORIES)
    strata = sampling.with_stratum(featured, [TARGET, "Accident"], ["Hour", "IsWeekend"])
    # The number is fixed by writing it out.
    coded = durable(encoding.apply_labels(strata, labels, CATEGORIES, unseen=0).withColumn(
        "row", F.monotonically_increasing_id()))
    names = [*numbers, *CLUSTER_FLAGS, *_encoded(CATEGORIES)]
    filled = encoding.feature_matrix(coded, ["row"], numbers, CLUSTER_FLAGS, _encoded(CATEGORIES))
    scaled = durable(
        encoding.fit_standard(filled, names).transform(filled).select("row", feature_array(names).alias("features")))
    sample = sampling.stratified_sample(coded, ["stratum"], ["row"], judged_rows, seed).select("row")
    sweep, models = clustering.k_sweep(scaled, "row", "features", ks, restarts, seed=seed, judged=sample)
    marked = durable(clustering.centroid_outliers(
        scaled, "features", models[k].by_id()))
    described = marked.drop("features").join(coded, "row")
    projected, ratios = clustering.project(scaled, "row", "features")
    return {
        "sweep": sweep,
        "sizes": clustering.cluster_sizes(marked),
        "profile": clustering.cluster_profile(
            described, "cluster", ["Hour", "Month"], ["IsWeekend", "Accident", "Alcohol"], ["VehicleAge"]),
        "top_classes": clustering.cluster_top_classes(described, "cluster", TARGET),
        "outliers": marked.drop("features"),
        "projection": projected.select("*", *[F.lit(r).alias(f"variance_{i + 1}") for i, r in enumerate(ratios)]),
    }


def stop_rules(first_year: int = 1900) -> list[cleaning.Rule]:
    """Validity of coordinates, vehicle year, date and clock."""
    day = col("Date Of Stop")
    return [
        cleaning.range_rule("latitude", col("Latitude"), -90.0, 90.0),
        cleaning.range_rule("longitude", col("Longitude"), -180.0, 180.0),
        cleaning.range_rule("year", col("Year"), first_year, 2025),
        cleaning.present_rule("date_missing", day),
        cleaning.range_rule("date_range", day, dt.datetime(2015, 1, 1), dt.datetime(2025, 12, 31)),
        cleaning.present_rule("clock", temporal.hour_of_clock(col("Time Of Stop"))),
    ]


def clean_for_outliers(
    stops: DataFrame, order: Sequence[str], first_year: int = 1900
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """First row of each stop that meets every rule, and the accounts of the cleaning."""
    wanted = [*LABELS, *BASES, *OUTLIER_FLAGS, *[c for c in CATEGORIES if c != "TimeOfDay"]]
    chosen = project(stops, [*dict.fromkeys([*wanted, *order])])
    # The de-duplicated rows feed every count below and all passes of the sampling.
    first = durable(cleaning.keep_first(chosen, ["SeqID"], order))
    rules = stop_rules(first_year)
    stages = [(r.name, r.met) for r in rules]
    reports = {
        "violations": cleaning.violation_counts(first, rules),
        "cleaning": cleaning.cleaning_report(first, stages, raw=chosen),
        "missing": profiling.missing_report(first),
    }
    return cleaning.valid_rows(first, rules), reports


def outlier_features(valid: DataFrame) -> DataFrame:
    """Calendar features of the joined date and clock, clipped age, coarse bins."""
    at = temporal.join_date_and_clock(col("Date Of Stop"), col("Time Of Stop"))
    age = temporal.years_since(col("Year"), 2025, clip=(0, 50))
    hour = F.hour("DateTime")
    return valid.withColumn("DateTime", at).select(
        "*", hour.alias("Hour"), F.month("DateTime").alias("Month"),
        temporal.day_of_week(F.col("DateTime")).alias("DayOfWeek"),
        temporal.weekend_flag(F.col("DateTime")).alias("IsWeekend"),
        temporal.day_band(hour).alias("TimeOfDay"), age.alias("VehicleAge"),
        binning.step_label(age, *binning.AGE_STEPS).alias("VehicleAge_Binned"),
        binning.step_label(hour, *binning.HOUR_STEPS).alias("Hour_Binned"),
    )


def screen_outliers(
    stops: DataFrame,
    order: Sequence[str],
    fit_rows: int | None = None,
    k: int = outliers.NEIGHBOURS,
    contamination: float = outliers.CONTAMINATION,
    seed: int = DEFAULT_SEED,
    neighbours: Callable[..., DataFrame] = nearest_neighbours,
    only_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Two outlier methods over all valid stops. Neighbours come from all of them, or, if the
    caller gives `fit_rows`, from a stratified sample of about so many; `only_rows` screens a
    sample of about so many by itself, as the sheet asks for. `order` is the total order that
    decides which row of a repeated stop comes first. `neighbours` finds the nearest rows."""
    valid, reports = clean_for_outliers(stops, order)
    # What only the order and the cleaning need is not written again.
    used = [*dict.fromkeys(["SeqID", TARGET, *OUTLIER_NUMBERS, *OUTLIER_FLAGS, *RULE_FLAGS, *CATEGORIES])]
    rows = durable(project(drop_null(outlier_features(valid)), used))
    labels = encoding.fit_labels(rows, CATEGORIES)
    coded = encoding.apply_labels(rows, labels, CATEGORIES)
    names = [*OUTLIER_NUMBERS, *OUTLIER_FLAGS, *_encoded(CATEGORIES)]
    filled = durable(encoding.feature_matrix(coded, ["SeqID"], OUTLIER_NUMBERS, OUTLIER_FLAGS, _encoded(CATEGORIES)))
    scaled = encoding.fit_standard(filled, names).transform(filled)
    vectors = scaled.select("SeqID", "Accident", feature_array(names).alias("features"))
    if only_rows is not None:
        vectors = sampling.stratified_sample(vectors, ["Accident"], ["SeqID"], only_rows, seed)
    vectors = durable(vectors)
    if fit_rows is None:
        flags = outliers.screen(vectors, "SeqID", "features", k, contamination, neighbours)
    else:
        sample = sampling.stratified_sample(vectors, ["Accident"], ["SeqID"], fit_rows, seed)
        flags = outliers.screen_by_sample(vectors, sample, "SeqID", "features", k, contamination)
    flags = durable(flags)
    marked = rows.join(flags, "SeqID")
    return {
        **reports,
        "sample_share": profiling.relative_frequency(rows, "Accident"),
        "rules": association.association_rules(rows, RULE_FLAGS),
        "strong_pairs": association.strong_pairs(rows, OUTLIER_NUMBERS),
        "matrix": encoding.matrix_quality(scaled, names),
        "flags": flags,
        "consensus": outliers.consensus(flags),
        "comparison": outliers.compare_groups(marked, "common_outlier", ["Accident", "Alcohol"], ["VehicleAge"]),
        "outlier_classes": profiling.class_distribution(marked.filter("common_outlier"), TARGET),
    }


def prepare(stops: DataFrame, seed: int = DEFAULT_SEED) -> dict[str, DataFrame]:
    """Impute, de-duplicate, split 60/20/20 by accident and encode on the training rows.

    Text values that the training rows lack take the code of their first class.
    """
    chosen = project(stops, [*PREPARED, "Location", "Accident"])
    imputed, log = cleaning.impute(chosen, UNKNOWN_FILLED, exclude=["Accident"])
    day, hour = col("Date Of Stop"), temporal.hour_before_colon(col("Time Of Stop"))
    age = temporal.years_since(col("Year"), 2025, clip=(0, 50))
    # Unique rows are their own keys from here on.
    stored = durable(imputed.dropDuplicates())
    keys = stored.columns
    parts = durable(sampling.train_validation_test_split(stored, ["Accident"], keys, seed=seed))
    # One copy of the rows is left for all that follows.
    discard(stored)
    unique = parts.select(*[col(k) for k in keys])
    built = unique.select(
        "*", temporal.day_of_week(day).alias("Weekday"), temporal.weekday_name(day).alias("WeekdayName"),
        temporal.weekend_flag(day).alias("IsWeekend"), F.month(day).alias("Month"),
        temporal.season(day).alias("Season"), hour.alias("Hour"),
        temporal.day_band(hour, "late_evening").alias("TimeOfDay"), age.alias("VehicleAge"),
        binning.cut_label(age, binning.AGE_EDGES, binning.AGE_LABELS).alias("VehicleAgeBand"),
    )
    built = quantiles.quantile_bins(built, {"Latitude": "LatitudeBand", "Longitude": "LongitudeBand"})
    # Columns of few values first, so that the one shuffle of a long list comes last.
    words = [c for c in columns_by_kind(parts)["categorical"] if c in PREPARED and c != "Charge"]
    words += [c for c in ("Charge",) if c in parts.columns]
    labels = encoding.fit_labels(parts.filter("split = 'train'"), words)
    coded = encoding.apply_labels(parts, labels, words, unseen=0, mark_unseen=True)
    return {
        "imputation": log,
        "constructed": built,
        "imbalance": profiling.imbalance_ratio(unique, "Accident"),
        "distribution": profiling.class_distribution(parts, "Accident", "split"),
        "encoded": coded.drop(*words, *[f"{w}_unseen" for w in words]),
        "replaced": encoding.unseen_report(coded, words, "split"),
    }


def centroid_screen(
    stops: DataFrame,
    order: Sequence[str],
    k: int = clustering.CLUSTERS,
    share: float = 0.05,
    restarts: int = clustering.RESTARTS,
    seed: int = DEFAULT_SEED,
) -> dict[str, DataFrame]:
    """k-means over one-hot categories and min-max numbers of all valid stops, and the rows
    farthest from their center."""
    valid, reports = clean_for_outliers(stops, order, first_year=2015)
    age = temporal.years_since(col("Year"), F.year(col("Date Of Stop")), negative_to_null=True)
    calendar = with_calendar(valid).withColumn("TimeOfDay", temporal.day_band(F.col("Hour"), "early_evening"))
    featured = calendar.select(
        "*", age.alias("VehicleAge"), binning.step_label(age, *binning.AGE_STEPS).alias("VehicleAge_Binned"),
        binning.step_label(F.col("Hour"), *binning.HOUR_STEPS).alias("Hour_Binned"))
    rows = durable(drop_null(featured))
    scaled = encoding.fit_minmax(rows, OUTLIER_NUMBERS).transform(rows)
    hot = encoding.one_hot(scaled, ONE_HOT)
    added = [c for c in hot.columns if c not in scaled.columns]
    vectors = durable(hot.select("SeqID", TARGET, feature_array([*OUTLIER_NUMBERS, *added]).alias("features")))
    model = clustering.fit_kmeans(vectors, "features", k, restarts, seed=seed)
    marked = durable(clustering.centroid_outliers(
        vectors, "features", model.by_id(), share)).drop("features")
    return {
        **reports,
        "strong_pairs": association.strong_pairs(rows, OUTLIER_NUMBERS),
        "marked": marked,
        "sizes": clustering.cluster_sizes(marked),
        "outliers_by_class": profiling.class_distribution(marked.filter("is_outlier"), TARGET),
    }
