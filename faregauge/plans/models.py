"""Regression forests for tip share and trip duration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregauge.operators import trees
from faregauge.operators.features import (
    WEATHER_FEATURES,
    drop_empty_columns,
    fill_numbers,
    sample_cap,
    split_train_test,
)
from faregauge.operators.medians import exact_medians
from faregauge.schemas import ML_RESULTS

_BOOKKEEPING = ("feature_id", "is_training", "fold")


# Fit 0 is on the whole training part, fit k + 1 leaves out fold k.
_WHOLE = 0

_TREE = (
    "tree int, feature array<smallint>, cut array<double>, left array<int>, value array<double>, gains array<double>"
)
_GROWN = f"fit int, part int, {_TREE}, row bigint, total double, target double, is_training boolean"
_ABOUT = "name string, target string, trees int, trees_per_task int, inputs array<string>"


@dataclass(frozen=True)
class Forest:
    """What to predict, what to leave out and how to grow the trees.

    ``rows`` bounds the sample a forest is grown on, and with it what a task holds.
    """

    name: str
    target: str
    leave_out: str
    depth: int
    trees: int = 200
    rows: int = 150_000
    folds: int = 5
    seed: int = 42
    trees_per_task: int = 20

    @property
    def parts(self) -> int:
        return -(-self.trees // self.trees_per_task)


TIP = Forest("tip_model", "tip_percentage", "trip_duration_min", depth=15)
DURATION = Forest("duration_model", "trip_duration_min", "tip_percentage", depth=20)


def training_rows(features: DataFrame, forest: Forest) -> DataFrame:
    """Capped, filled and split rows for one model."""
    usable = drop_empty_columns(features, forest.target)
    numeric = [c for c in usable.columns if c not in _BOOKKEEPING]
    usable = fill_numbers(usable, exact_medians(usable, numeric, only_gappy=True))
    capped = sample_cap(usable, forest.rows, seed=forest.seed)
    return split_train_test(capped, seed=forest.seed)


def inputs(rows: DataFrame, forest: Forest) -> list[str]:
    skipped = {forest.target, forest.leave_out, *_BOOKKEEPING}
    return [c for c in rows.columns if c not in skipped]


def _numbers(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _by_input(x: pa.ChunkedArray, inputs: int) -> np.ndarray:
    """Inputs by rows; a missing one is no number."""
    flat = x.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.ascontiguousarray(flat.reshape(len(x), inputs).T)


def _grow_part(forest: Forest, n_inputs: int):
    """Some trees of one fit, from all sampled rows, and the sums of what they predict.

    Rows are put in the order of their keys first, so trees don't depend on partitions. Sums
    are returned for the rows that measure the fit: all of them for the whole one, else the
    fold that it leaves out.
    """

    def step(key: tuple, rows: pa.Table) -> pa.Table:
        number, part = (k.as_py() for k in key)
        rows = rows.sort_by("feature_id")
        x, y = _by_input(rows.column("x"), n_inputs), rows.column("target").to_numpy()
        held = rows.column("held").to_numpy()
        chosen = np.flatnonzero(~held)
        asked = np.arange(len(y)) if number == _WHOLE else np.flatnonzero(held)
        total = np.zeros(len(asked))
        grown = []
        first = part * forest.trees_per_task
        for tree in range(first, min(first + forest.trees_per_task, forest.trees)):
            weight = trees.bootstrap(len(y), chosen, (forest.seed, number, tree))
            found = trees.grow(x, y, weight, forest.depth)
            total += found.predict(x[:, asked])
            if number == _WHOLE:
                grown.append((tree, found.feature, found.cut, found.left, found.value, found.gains))
        sums = pa.table(
            {
                "row": rows.column("feature_id").take(pa.array(asked)),
                "total": pa.array(total),
                "target": pa.array(y[asked]),
                "is_training": pa.array(~held[asked]),
            }
        )
        kinds = [pa.int32(), *map(pa.list_, (pa.int16(), pa.float64(), pa.int32(), pa.float64(), pa.float64()))]
        names = ["tree", "feature", "cut", "left", "value", "gains"]
        columns = zip(*grown, strict=True) if grown else [[]] * len(names)
        nodes = pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})
        both = pa.concat_tables([nodes, sums], promote_options="default")
        both = both.append_column("fit", pa.array([number] * len(both), pa.int32()))
        both = both.append_column("part", pa.array([part] * len(both), pa.int32()))
        order = ["fit", "part", *names, "row", "total", "target", "is_training"]
        return both.select(order)

    return step


def spread(rows: DataFrame, forest: Forest, names: Sequence[str]) -> DataFrame:
    """What each task returns: rows are sent once to every pair of a fit and a part of its trees."""
    fits = F.explode(F.sequence(F.lit(0), F.when(F.col("is_training"), forest.folds).otherwise(0))).alias("fit")
    parts = F.explode(F.sequence(F.lit(0), F.lit(forest.parts - 1))).alias("part")
    target = F.col(forest.target).cast("double").alias("target")
    sent = rows.select("feature_id", _numbers(names).alias("x"), target, "is_training", "fold", fits)
    held = F.when(F.col("fit") == _WHOLE, ~F.col("is_training")).otherwise(F.col("fold") + 1 == F.col("fit"))
    sent = sent.select("feature_id", "x", "target", held.alias("held"), "fit", parts)
    tasks = (forest.folds + 1) * forest.parts
    # A stated number keeps adaptive execution from merging small but dear partitions.
    tasked = sent.repartition(2 * tasks, "fit", "part").groupBy("fit", "part")
    return tasked.applyInArrow(_grow_part(forest, len(names)), _GROWN)


def fit(rows: DataFrame, forest: Forest, path: str) -> FittedForest:
    """Grow a forest and its cross-validation on split ``rows``, all in one stage, under ``path``.

    ``rows`` has at most ``forest.rows`` rows with ``feature_id``, ``is_training`` and ``fold``.
    A task gets all of them, which is a few megabytes, and grows some trees of one fit. Splits
    are exact, as no input is binned.
    """
    names = inputs(rows, forest)
    kind = F.when(F.col("tree").isNotNull(), "tree").otherwise("sum").alias("kind")
    grown = spread(rows, forest, names).select("*", kind)
    grown.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/grown")
    about = [(forest.name, forest.target, forest.trees, forest.trees_per_task, names)]
    spark = rows.sparkSession
    spark.createDataFrame(about, _ABOUT).coalesce(1).write.mode("overwrite").json(f"{path}/about")
    return FittedForest(spark, path)


def _predict_cell(n_inputs: int):
    def step(rows: pa.Table, grown: pa.Table) -> pa.Table:
        x = _by_input(rows.column("x"), n_inputs)
        total = np.zeros(len(rows))
        for at in range(len(grown)):
            node = [grown.column(c)[at].values.to_numpy() for c in ("feature", "cut", "left", "value", "gains")]
            total += trees.Tree(*node).predict(x)
        return pa.table({"row": rows.column("row"), "total": pa.array(total)})

    return step


class FittedForest:
    """A forest under a path: one row per tree, sums of its predictions, and what it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        about = spark.read.schema(_ABOUT).json(f"{path}/about").first()
        self.inputs: list[str] = list(about["inputs"])
        self.target: str = about["target"]
        self.n_trees: int = about["trees"]
        self.n_parts = -(-about["trees"] // about["trees_per_task"])
        self._grown = spark.read.schema(f"{_GROWN}, kind string").parquet(f"{path}/grown")

    @property
    def trees(self) -> DataFrame:
        """One row per tree, its nodes as arrays."""
        columns = ("part", "tree", "feature", "cut", "left", "value", "gains")
        return self._grown.where("kind = 'tree'").select(*columns)

    def measured(self) -> DataFrame:
        """(fit, row, target, is_training, prediction) of the rows each fit is measured on."""
        by = ("fit", "row", "target", "is_training")
        sums = self._grown.where("kind = 'sum'").groupBy(*by)
        return sums.agg((F.sum("total") / self.n_trees).alias("prediction"))

    def transform(self, rows: DataFrame, key: str = "feature_id", per_cell: int = 200_000) -> DataFrame:
        """``rows``, whose ``key`` is unique, with ``prediction``.

        Rows meet the forest in cells of some ``per_cell`` rows and the trees of one part, so a
        task holds neither all trees nor all rows, and predictions of the parts are added up.
        """
        cells = -(-rows.count() // per_cell) or 1
        cell = F.pmod(F.xxhash64(key), F.lit(cells)).cast("int").alias("cell")
        parts = F.explode(F.sequence(F.lit(0), F.lit(self.n_parts - 1))).alias("part")
        sent = rows.select(F.col(key).alias("row"), _numbers(self.inputs).alias("x"), cell, parts)
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell")
        grown = self.trees.select("*", everywhere)
        by = ("part", "cell")
        kind = rows.schema[key].dataType.simpleString()
        found = (
            sent.groupBy(*by)
            .cogroup(grown.groupBy(*by))
            .applyInArrow(_predict_cell(len(self.inputs)), f"row {kind}, total double")
            .groupBy(F.col("row").alias(key))
            .agg((F.sum("total") / self.n_trees).alias("prediction"))
        )
        return rows.join(found, key)


def error_measures(label: str, prediction: str = "prediction") -> list[Column]:
    """RMSE, MAE and R² as aggregates, so that one pass gives all three."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    squares = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count("*")
    # A constant target has no spread to explain: 1 if it is met exactly, else 0.
    constant = F.when(squares == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return [
        F.sqrt(squares / F.count("*")).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.when(spread > 0, 1 - F.try_divide(squares, spread)).otherwise(constant).alias("r2"),
    ]


def evaluate(predictions: DataFrame, label: str, *by: str) -> DataFrame:
    """Errors of stored predictions, overall or per group."""
    return predictions.groupBy(*by).agg(*error_measures(label))


def cross_validate(model: FittedForest) -> DataFrame:
    """(fold, errors) on each held-out fold of the training part."""
    held_out = model.measured().where(F.col("fit") != _WHOLE).withColumn("fold", F.col("fit") - 1)
    return evaluate(held_out, "target", "fold")


def train(features: DataFrame, forest: Forest, path: str) -> DataFrame:
    """Fit, cross-validate and evaluate one forest, which is kept under ``path``.

    Returns one row of metrics.
    """
    spark = features.sparkSession
    model = fit(training_rows(features, forest), forest, path)
    cv = cross_validate(model).agg(*[F.avg(c).alias(f"cv_{c}") for c in ("rmse", "mae", "r2")]).first()
    whole = model.measured().where(F.col("fit") == _WHOLE)
    scored = whole.groupBy("is_training").agg(*error_measures("target"), F.count("*").alias("n"))
    parts = {row["is_training"]: row for row in scored.collect()}
    training, test = parts[True], parts.get(False)
    return spark.createDataFrame(
        [
            (
                forest.name,
                cv["cv_rmse"],
                cv["cv_mae"],
                cv["cv_r2"],
                training["rmse"],
                test["rmse"] if test else None,
                test["r2"] if test else None,
                training["n"],
                test["n"] if test else 0,
            )
        ],
        "model string, cv_rmse double, cv_mae double, cv_r2 double, train_rmse double,"
        " test_rmse double, test_r2 double, n_train bigint, n_test bigint",
    )


def importances(model: FittedForest, column: str) -> DataFrame:
    """Importance of each input: its share of what a tree's cuts gain, averaged over the trees."""
    total = F.aggregate("gains", F.lit(0.0), lambda a, g: a + g)
    shares = F.when(total > 0, F.transform("gains", lambda g: g / total)).otherwise(
        F.transform("gains", lambda g: F.lit(0.0))
    )
    names = F.array(*[F.lit(n) for n in model.inputs])
    each = model.trees.select(F.posexplode(shares).alias("at", "share"))
    means = each.groupBy("at").agg(F.avg("share").alias("mean"))
    whole = F.sum("mean").over(Window.partitionBy())
    share = F.when(whole > 0, F.col("mean") / whole).otherwise(F.lit(0.0)).alias(column)
    return means.select(F.get(names, F.col("at")).alias("feature_name"), share)


def feature_union(tip: DataFrame, duration: DataFrame) -> DataFrame:
    """Features of either model; an importance a model lacks is 0."""
    return tip.join(duration, "feature_name", "full_outer").select(
        "feature_name",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("importance_tip", "importance_duration")],
    )


def feature_importance(tip: DataFrame, duration: DataFrame) -> DataFrame:
    """Both importances, their mean and whether the feature describes the weather."""
    mean = (F.col("importance_tip") + F.col("importance_duration")) / 2
    return (
        feature_union(tip, duration)
        .withColumn("importance_avg", mean)
        .withColumn("is_weather", F.col("feature_name").isin(*WEATHER_FEATURES))
        .select(ML_RESULTS.fieldNames())
        .orderBy(F.desc("importance_tip"), "feature_name")
    )


def weather_split_sum(results: DataFrame) -> DataFrame:
    """Importance of weather features and of all others."""
    return results.groupBy("is_weather").agg(
        F.count("*").alias("features"),
        F.sum("importance_tip").alias("importance_tip"),
        F.sum("importance_duration").alias("importance_duration"),
    )


def top_weather_features(results: DataFrame, top: int = 3) -> DataFrame:
    return (
        results.where("is_weather")
        .orderBy(F.desc("importance_avg"), "feature_name")
        .drop("is_weather")
        .limit(top)
    )


def weather_impact(results: DataFrame, significant_pct: float = 15.0) -> DataFrame:
    """Share of the importance that weather features carry, in one row."""

    def total(column: str, weather: bool) -> Column:
        picked = F.col("is_weather") if weather else ~F.col("is_weather")
        return F.coalesce(F.sum(F.when(picked, F.col(column))), F.lit(0.0))

    columns: dict[str, Column] = {}
    for kind in ("tip", "duration"):
        inside, outside = (total(f"importance_{kind}", side) for side in (True, False))
        share = F.when(inside + outside > 0, inside / (inside + outside) * 100).otherwise(F.lit(0.0))
        columns[f"weather_impact_{kind}_pct"] = F.round(share, 2)
        columns[f"weather_importance_total_{kind}"] = F.round(inside, 6)
        columns[f"non_weather_importance_total_{kind}"] = F.round(outside, 6)
        columns[f"is_{kind}_significant"] = share > significant_pct
    columns["weather_features_count"] = F.count_if("is_weather")
    columns["non_weather_features_count"] = F.count_if(~F.col("is_weather"))
    return results.agg(*[column.alias(name) for name, column in columns.items()])


def load_model(spark: SparkSession, path: str) -> FittedForest:
    return FittedForest(spark, path)


def all_metrics(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """Metrics of several models, one row each."""
    return reduce(DataFrame.unionByName, metrics.values())
