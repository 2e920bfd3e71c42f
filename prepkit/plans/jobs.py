"""The end-to-end jobs: files in, cleaned and enriched tables, figures and reports out.

Each job takes a session and paths or tables and returns frames; writing them is the
caller's choice. Scheduling is left to whatever runs the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions import cells, markup
from prepkit.operators import columns, impute, lookup, profile, rows, scale, shapes, split
from prepkit.operators.columns import Roles
from prepkit.plans import models, robustness, scoring
from prepkit.plans.rates import AGE_RATES_COARSE, AGE_RATES_FINE, SEX_RATES
from prepkit.sources import readers
from prepkit.sources.frozen import frozen, spread

# --- used cars ----------------------------------------------------------------------

# Columns of a used-car file.
CAR_SCHEMA = "car_model string, year_of_manufacture int, price double, fuel string"


def used_cars(spark: SparkSession, folder: str) -> DataFrame:
    """CSV, JSON Lines and XML of a folder: prices to two decimals, the first row of each model."""
    cars = readers.ingest_folder(spark, folder, CAR_SCHEMA)
    priced = cars.withColumn("price", cells.half_even("price", 2))
    first = rows.first_per_key(priced, ["car_model"], readers.READING_ORDER)
    return first.drop(*readers.READING_ORDER)


# --- words --------------------------------------------------------------------------


def frequent_words(spark: SparkSession, path: str, at_least: int = 3) -> DataFrame:
    """Tokens of text files seen at least that often."""
    return profile.word_counts(readers.read_text(spark, path), "value", at_least)


# --- census -------------------------------------------------------------------------

# Columns of a census file.
CENSUS_SCHEMA = (
    "age int, workclass string, fnlwgt float, education string, education_num float, marital_status string, "
    "occupation string, relationship string, race string, sex string, capital_gain float, capital_loss float, "
    "hours_per_week float, native_country string, income string"
)
# Share of men and women by marital status.
MARITAL_SHARES = (
    ("Never-married", 47.35, 41.81),
    ("Married-AF-spouse", 67.54, 68.33),
    ("Widowed", 3.58, 11.61),
    ("Divorced", 10.82, 15.09),
)
MARITAL_SCHEMA = "marital_status_statistics string, male double, female double"


@dataclass(frozen=True)
class Census:
    """What the census job yields."""

    data: DataFrame
    missing: DataFrame
    gain_by_status: DataFrame
    divorced: DataFrame
    joined: DataFrame
    aged_30_to_50: DataFrame


def census(spark: SparkSession, path: str) -> Census:
    """Typed and trimmed rows, products of the integer columns, gain by marital status, shares joined."""
    raw = readers.read_csv(spark, path, schema=CENSUS_SCHEMA, header=False)
    typed = columns.trim_strings(columns.cast_columns(raw, "float", "int"))
    complete = rows.drop_nulls(typed)
    data = columns.with_pairwise_products(complete, columns.columns_of(complete, "integer"), with_self=True)
    shares = lookup.inline_table(spark, MARITAL_SHARES, MARITAL_SCHEMA)
    return Census(
        data=data,
        missing=profile.missing_counts(typed),
        gain_by_status=profile.group_mean(data, ["marital_status"], "capital_gain", "average_capital_gain"),
        divorced=rows.matching(data, marital_status="Divorced"),
        joined=lookup.outer_join_reference(data, shares, "marital_status", "marital_status_statistics"),
        aged_30_to_50=rows.in_ranges(data, {"age": (30, 50)}),
    )


# --- smoking rates from stored pages ------------------------------------------------

# Where the rates stand on the two stored pages.
RATE_LISTS = {"class": "block-list", "sex": 1, "age": 2}
RATE_CAPTION = "Proportion of people 15 years and over who were current daily smokers by age, 2011–12 to 2022"
RATE_SERIES = 7


def sex_rates(pages: DataFrame) -> DataFrame:
    """``gender, percentage`` of pages whose second list names men, then women."""
    entries = markup.list_items("html", RATE_LISTS["sex"], RATE_LISTS["class"])
    found = pages.select(F.posexplode(entries).alias("pos", "item")).where("pos < 2")
    return found.select(F.when(F.col("pos") == 0, "male").otherwise("female").alias("gender"),
                        markup.percent("item").alias("percentage"))


def age_rates_coarse(pages: DataFrame) -> DataFrame:
    """``age_range, percentage`` of pages whose third list names age groups."""
    entries = markup.list_items("html", RATE_LISTS["age"], RATE_LISTS["class"])
    found = pages.select(F.explode(entries).alias("item"))
    label = markup.matched_label("item", [b for *_, b in cells.AGE_BRACKETS_COARSE])
    return found.select(label.alias("age_range"), markup.percent("item").alias("percentage")).where("age_range IS NOT NULL")


def age_rates_fine(pages: DataFrame) -> DataFrame:
    """``age_range, percentage`` of pages holding the chart of daily smokers by age."""
    series = markup.captioned_series("html", RATE_CAPTION, RATE_SERIES)
    labels = F.array(*[F.lit(b) for *_, b in cells.AGE_BRACKETS_FINE])
    found = pages.select(F.posexplode(series).alias("pos", "percentage"))
    return found.select(F.get(labels, F.col("pos")).alias("age_range"), "percentage").where("age_range IS NOT NULL")


def rate_map(table: DataFrame) -> dict[str, float]:
    """A two-column rate table as a mapping, for rates used as literals (a few brackets)."""
    if lookup.small(table) is None:
        raise ValueError("a rate table has a row per bracket; join larger ones with lookup_default")
    return {r[0]: r[1] for r in table.collect()}


# --- heart disease ------------------------------------------------------------------

# The columns kept for modelling.
HEART_COLUMNS = ["age", "sex", "painloc", "painexer", "cp", "trestbps", "smoke", "fbs", "prop", "nitr", "pro",
                 "diuretic", "thaldur", "thalach", "exang", "oldpeak", "slope", "target"]
# The part each column plays, and what values are valid.
HEART_ROLES = Roles(
    numerical=("age", "trestbps", "thaldur", "thalach", "oldpeak"),
    categorical=("cp", "slope"),
    binary=("sex", "painloc", "painexer", "smoke", "fbs", "prop", "nitr", "pro", "diuretic", "exang"),
    label="target",
)
HEART_RANGES: dict[str, tuple[float | None, float | None]] = {"trestbps": (100.0, None), "oldpeak": (0.0, 4.0)}
HEART_BINARY = {c: (None, 1.0) for c in ("fbs", "prop", "nitr", "pro", "diuretic", "exang")}


def heart_clean(df: DataFrame, key: str, threshold: float = 0.9, inclusive: bool = False) -> DataFrame:
    """Drop sparse rows, keep the modelling columns, repair and fill all but ``smoke``."""
    dense = rows.drop_sparse_rows(df, threshold, inclusive)
    typed = dense.select(key, *[cells.to_number(c).alias(c) for c in HEART_COLUMNS])
    # the columns do not depend on each other, so one fit for all means and one for all modes
    means = impute.fit_means(typed, [*HEART_RANGES, "thaldur", "thalach"], HEART_RANGES)
    modes = impute.fit_modes(typed, [*HEART_BINARY, "painloc", "painexer", "slope", "cp"], HEART_BINARY)
    return impute.repair(typed, {**means, **modes}, {**HEART_RANGES, **HEART_BINARY})


def heart_fill_smoke(
    df: DataFrame, key: str, how: str = "chance", male: Any = 1.0, seed: int = 42,
    sex: dict[str, float] | None = None, coarse: dict[str, float] | None = None, fine: dict[str, float] | None = None,
) -> DataFrame:
    """Fill ``smoke``: by a draw per row (``chance``), or by exact counts per sex and bracket (``quota``)."""
    sex_map, coarse_map, fine_map = sex or SEX_RATES, coarse or AGE_RATES_COARSE, fine or AGE_RATES_FINE
    if how == "chance":
        chance = impute.smoking_chance("sex", "age", cells.AGE_BRACKETS_COARSE, coarse_map,
                                       cells.AGE_BRACKETS_FINE, fine_map, sex_map, male)
        return impute.bernoulli_impute(df, "smoke", chance, key, seed)
    if how != "quota":
        raise ValueError(f"unknown way: {how}")
    ratio = F.when(F.col("sex") == male, sex_map["male"] / sex_map["female"]).otherwise(1.0)
    made = df.withColumn("_bracket", cells.bracket("age", cells.AGE_BRACKETS_FINE)).withColumn(
        "_chance", impute.rate_by_bracket("age", cells.AGE_BRACKETS_FINE, fine_map, ratio))
    return impute.quota_impute(made, "smoke", ["sex", "_bracket"], "_chance", key, seed).drop("_bracket", "_chance")


def heart_report(
    df: DataFrame, key: str, label: str = "target", grids: dict[str, dict[str, Sequence[Any]]] | None = None,
    folds: int = 5, fraction: float = 0.1, seed: int = 42, parallelism: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Grid-search the classifiers by F1, score the best of each on held-out rows: metrics, and a text report."""
    features = [c for c in df.columns if c not in (label, key)]
    parted = frozen(split.with_part(df, label, key, fraction, seed, "_part"), "heart")
    train, test = [parted.where(F.col("_part") == p).drop("_part") for p in ("train", "test")]
    found = []
    for rank, (name, grid) in enumerate((grids or models.GRIDS).items()):
        search = models.grid_search(train, models.feature_stages(features), models.classifier(name, label, seed=seed),
                                    grid, key, "f1", folds, parallelism=parallelism, seed=seed)
        s = scoring.classification_scores(search.transform(test), label, "prediction").first()
        found.append((rank, name, s["accuracy"], s["precision"], s["recall"], s["f1"]))
    metrics = scoring.metrics_table(df.sparkSession, found)
    return metrics, scoring.text_report(metrics)


def heart_comparison(df: DataFrame, key: str, label: str = "target", fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Six models: logistic regression and a kernel SVM on plain, squared, and smoke-free gap-free columns."""
    features = [c for c in df.columns if c not in (label, key)]
    # what makes the rows runs once; six trainings pass over them, three with features hundreds of times as wide
    kept = spread(frozen(df, "heart"), 1)
    whole = rows.drop_null_columns(kept.drop("smoke"))
    bare = [c for c in features if c in whole.columns]
    train, test = split.random_split(kept, [1.0 - fraction, fraction], key, seed)
    sets = {"1": (features, False), "2": (features, True), "3": (bare, False)}
    entries = {f"lr{n}": (models.feature_stages(chosen, squares=squares), models.classifier("Logistic Regression", label))
               for n, (chosen, squares) in sets.items()}
    for n, (chosen, squares) in sets.items():
        entries[f"svm{n}"] = (models.fitted_kernel_stages(train, chosen, squares), models.classifier("Linear SVM", label, regParam=1e-3, maxIter=30))
    return models.compare_models(train, test, entries)


def heart_profile(df: DataFrame, roles: Roles) -> dict[str, DataFrame]:
    """Mask outliers of the numbers, fill everything by mode, recode the protocol, describe the result."""
    masked = rows.iqr_mask(df, list(roles.numerical))
    valid = impute.repair(masked, impute.fit_modes(masked, list(roles.binary)), {c: [0, 1] for c in roles.binary})
    if "proto" in valid.columns:
        valid = valid.withColumn("proto", cells.recode("proto", cells.PROTOCOL_RULES))
    clean = impute.mode_fill(valid, [*roles.numerical, *roles.categorical])
    return {
        "clean": clean,
        "boxes": profile.box_summary(clean, list(roles.numerical)),
        "correlations": profile.corr_matrix(clean, list(roles.numerical)),
        "counts": profile.value_counts(clean, [*roles.categorical, *roles.binary]),
    }


# --- passengers ---------------------------------------------------------------------


def passengers(
    df: DataFrame, label: str = "Survived", key: str = "PassengerId", ignored: Sequence[str] = ("Name",),
    grid: dict[str, Sequence[Any]] | None = None, folds: int = 3, share: float = 0.8, seed: int = 7576, indexed: int = 10_000,
) -> tuple[models.Search, DataFrame]:
    """Forest over filled, multiplied and squared columns, chosen by AUC: the search and ``auc, max_depth``.

    A string column of more than ``indexed`` values counts by the place of its value by frequency, as a number.
    """
    roles = Roles.of(df, label, [key, *ignored])
    wide = impute.wide_columns(df, roles.categorical, indexed)
    for c in wide:
        df = scale.frequency_index(df, c, f"{c}_place").drop(c)
    roles = replace(roles, categorical=tuple(c for c in roles.categorical if c not in wide), numerical=(*roles.numerical, *[f"{c}_place" for c in wide]))
    kept = frozen(df, "passengers")
    train, test = split.random_split(kept, [share, 1.0 - share], key, seed)
    stages = models.passenger_stages(roles.numerical, roles.categorical)
    search = models.grid_search(train, stages, models.classifier("Random Forest", label, seed=seed),
                                grid or models.FOREST_GRID, key, "areaUnderROC", folds, stratify=False, seed=seed)
    from pyspark.ml.functions import vector_to_array

    scored = search.transform(test).withColumn("_score", F.get(vector_to_array("probability"), F.lit(1)))
    auc = scoring.roc_auc(scored, label, "_score")
    return search, auc.withColumn("max_depth", F.lit(models.best_parameter(search, "maxDepth")))


# --- flights ------------------------------------------------------------------------

# The delay columns of a flight.
DELAYS = ["DepDelay", "ArrDelay", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


def flights(df: DataFrame, width: float = 50.0, delays: Sequence[str] = DELAYS) -> dict[str, DataFrame]:
    """Delay boxes and correlations, the late-aircraft pattern, and air time by distance bin."""
    # every figure below reads the deduplicated rows
    distinct = frozen(rows.distinct_rows(df), "flights")
    late = rows.in_ranges(distinct, {"DepDelay": (0, None), "ArrDelay": (0, None)})
    longest = distinct.agg(F.max("Distance")).first()[0] or 0
    # the last edge is the largest multiple of the width below the longest distance plus one width
    bins = max(int((int(longest) + width - 1) // width), 1)
    binned = distinct.withColumn("bin", cells.fixed_bin("Distance", width, bins)).where("bin IS NOT NULL")
    names = ("Both", "Only Arrival", "Only Late Aircraft")
    return {
        "distinct": distinct,
        "boxes": profile.box_summary(distinct, delays),
        "late_boxes": profile.box_summary(late, delays),
        "positive_boxes": profile.box_summary(distinct, delays, positive_only=True),
        "pattern": rows.split_by_null_pattern(distinct, "ArrDelay", "LateAircraftDelay", names),
        "correlations": profile.corr_matrix(distinct, delays, above=0.0),
        "correlations_from_zero": profile.corr_matrix(distinct, delays, at_least=0.0),
        "distance_air_time": profile.corr_matrix(distinct, ["Distance", "AirTime"]),
        "shape": profile.skew_kurtosis(rows.drop_nulls(distinct, ["Distance", "AirTime"]), ["Distance", "AirTime"]),
        "by_distance": profile.binned_stats(binned, ["bin"], "AirTime"),
        "normality": profile.normality(binned, ["bin"], "AirTime"),
        "rank_normality": shapes.rank_normality(binned, ["bin"], "AirTime"),
        "violins": profile.box_by_group(binned, ["bin"], "AirTime"),
        "curves": shapes.density_by_group(binned, ["bin"], "AirTime"),
    }


# --- wines --------------------------------------------------------------------------


@dataclass(frozen=True)
class Wines:
    """What the wine job yields."""

    clean: DataFrame
    scalings: DataFrame
    accuracies: DataFrame
    decision: str
    robustness: DataFrame | None


def wines(
    df: DataFrame, key: str, label: str = "Wine", ratio: float = 0.2, factor: float = 3.0, tolerance: float = 0.01,
    noise: float = 1.2, trials: int = 50, confidence: float = 0.95, seed: int = 42, mode: str = "sequential",
) -> Wines:
    """Clean, split, train the plain, product and maximum variants, and stress-test the chosen one."""
    complete = rows.drop_nulls(df)
    numbers = columns.columns_of(complete, "numeric", [label, key])
    kept = rows.zscore_filter(complete, numbers, factor, tolerance, mode)
    clean = frozen(scale.label_encode(kept, columns.columns_of(kept, "string", [label, key])), "wines")
    features = columns.columns_of(clean, "numeric", [label, key])
    train, test = split.random_split(clean, [1.0 - ratio, ratio], key, seed)
    found = {v: robustness.validation_accuracy(train, features, label, key, v, ratio, seed) for v in robustness.VARIANTS}
    decision = scoring.choose_challenger(found["plain"], {"max": found["max"], "product": found["product"]}, tolerance)
    spark = df.sparkSession
    stressed = None
    if decision != "keep":
        model = robustness.train_variant(train, features, label, decision)
        stressed = robustness.robustness(model, test, key, noise, trials, confidence, seed)
    made = robustness.engineered(robustness.engineered(train, features, "product"), features, "max")
    scaled = [c for c in made.columns if c in features or c not in train.columns]
    return Wines(
        clean=clean,
        scalings=scale.scaling_table(spark, scale.fit_minmax(made, scaled)),
        accuracies=spark.createDataFrame(list(found.items()), "variant string, accuracy double"),
        decision=decision,
        robustness=stressed,
    )
