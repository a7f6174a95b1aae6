"""Trees against brute force, forests on tables, and what a saved forest gives back."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faregauge.operators import features, trees
from faregauge.plans import models


def squares(y, w):
    return float((w * (y - np.average(y, weights=w)) ** 2).sum()) if w.sum() else 0.0


def least_error(x, y, w):
    """Error of the best of all cuts, tried one by one; None without a cut."""
    errors = []
    for values in x:
        for cut in np.unique(values)[:-1]:
            left = values <= cut
            errors.append(squares(y[left], w[left]) + squares(y[~left], w[~left]))
    return min(errors, default=None)


def check_node(tree, at, x, y, w, depth):
    assert tree.value[at] == pytest.approx(np.average(y, weights=w), abs=1e-6)
    best = least_error(x, y, w) if depth and len(np.unique(y)) > 1 else None
    if best is None:
        assert tree.feature[at] == trees.LEAF
        return
    left = x[tree.feature[at]] <= tree.cut[at]
    assert 0 < left.sum() < len(y)
    found = squares(y[left], w[left]) + squares(y[~left], w[~left])
    assert found == pytest.approx(best, abs=1e-6)
    for child, side in ((tree.left[at], left), (tree.left[at] + 1, ~left)):
        check_node(tree, child, x[:, side], y[side], w[side], depth - 1)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(*[st.integers(-3, 3)] * 3, st.integers(-9, 9), st.integers(0, 3)), min_size=1, max_size=25),
    st.integers(0, 6),
)
def test_every_cut_is_the_best_one(rows, depth):
    """Ties, repeated rows, constant inputs and rows of no weight included."""
    table = np.array(rows, np.float64).T
    x, y, w = table[:3], table[3], table[4]
    if not w.sum():
        w = w + 1
    tree = trees.grow(x, y, w, depth)
    used = w > 0
    x, y, w = x[:, used], y[used], w[used]
    check_node(tree, 0, x, y, w, depth)
    found = tree.predict(x)
    left_over = sum(squares(y[found == v], w[found == v]) for v in np.unique(found))
    assert squares(y, w) - tree.gains.sum() == pytest.approx(left_over, abs=1e-6)


def test_infinities_and_missing_inputs():
    x = np.array([[-np.inf, 0.0, 1.0, np.inf]])
    y = np.array([1.0, 2.0, 3.0, 4.0])
    tree = trees.grow(x, y, np.ones(4), 5)
    assert tree.predict(x).tolist() == y.tolist()
    assert tree.predict(np.array([[np.nan]])).tolist() == [4.0]


def test_neighbouring_numbers_are_told_apart():
    low = 1.0
    x = np.array([[low, np.nextafter(low, 2)]])
    tree = trees.grow(x, np.array([0.0, 1.0]), np.ones(2), 3)
    assert tree.predict(x).tolist() == [0.0, 1.0]


def test_no_rows():
    tree = trees.grow(np.zeros((2, 0)), np.zeros(0), np.zeros(0), 3)
    assert tree.feature.tolist() == [trees.LEAF] and tree.value.tolist() == [0.0]


def test_bootstrap_draws_from_the_chosen_rows():
    drawn = trees.bootstrap(10, np.array([2, 5, 7]), (42, 0, 1))
    assert drawn.sum() == 3 and set(np.flatnonzero(drawn)) <= {2, 5, 7}
    assert drawn.tolist() == trees.bootstrap(10, np.array([2, 5, 7]), (42, 0, 1)).tolist()
    assert not trees.bootstrap(4, np.zeros(0, np.int64), (1,)).any()


def sample(spark, n=300):
    rows = spark.range(1, n + 1).select(
        F.col("id").alias("feature_id"),
        (F.col("id") * 37 % 101).cast("double").alias("trip_distance"),
        (F.col("id") % 4).cast("int").alias("passenger_count"),
        (F.col("id") * 37 % 101 % 10).cast("float").alias("tip_percentage"),
        F.lit(1.0).cast("float").alias("trip_duration_min"),
    )
    return features.split_train_test(rows)


FOREST = models.Forest("tip_model", "tip_percentage", "trip_duration_min", depth=6, trees=7, trees_per_task=3)


def predictions(frame):
    return {row[0]: row[1] for row in frame.collect()}


def test_forest_of_a_table_is_that_of_plain_trees(spark, tmp_path):
    """Whole fit and folds, rebuilt without Spark, and the saved forest asked in small cells."""
    rows = sample(spark)
    model = models.fit(rows, FOREST, str(tmp_path / "m"))
    plain = sorted(rows.select("feature_id", *model.inputs, "tip_percentage", "is_training", "fold").collect())
    x = np.array([row[1:3] for row in plain], np.float64).T
    y = np.array([row[3] for row in plain], np.float64)
    training, fold = (np.array([row[i] for row in plain]) for i in (4, 5))
    for number in range(FOREST.folds + 1):
        # Only the whole fit knows rows outside the training part.
        own = np.ones(len(y), bool) if number == 0 else training
        held = ~training if number == 0 else fold + 1 == number
        chosen = np.flatnonzero(~held[own])
        total = np.zeros(own.sum())
        for tree in range(FOREST.trees):
            weight = trees.bootstrap(own.sum(), chosen, (FOREST.seed, number, tree))
            total += trees.grow(x[:, own], y[own], weight, FOREST.depth).predict(x[:, own])
        asked = np.ones(len(total), bool) if number == 0 else held[own]
        ids = np.array([row[0] for row in plain])[own][asked]
        want = dict(zip(ids.tolist(), (total[asked] / FOREST.trees).tolist(), strict=True))
        found = predictions(model.measured().where(F.col("fit") == number).select("row", "prediction"))
        assert found == pytest.approx(want)
        if number == 0:
            again = model.transform(rows, per_cell=70).select("feature_id", "prediction")
            assert predictions(again) == pytest.approx(want)


def test_forest_does_not_depend_on_partitions(spark, tmp_path):
    """The same trees from rows in another order and in one partition."""
    one = models.fit(sample(spark), FOREST, str(tmp_path / "a")).trees
    other = models.fit(sample(spark).orderBy(F.desc("feature_id")).coalesce(1), FOREST, str(tmp_path / "b")).trees
    assert one.count() == FOREST.trees and one.exceptAll(other).isEmpty()


def test_missing_inputs_are_predicted(spark, tmp_path):
    model = models.fit(sample(spark), FOREST, str(tmp_path / "m"))
    gaps = sample(spark, 5).withColumn("trip_distance", F.lit(None).cast("double"))
    assert len(predictions(model.transform(gaps).select("feature_id", "prediction"))) == 5
    assert model.transform(gaps.limit(0)).isEmpty()


def test_training_shuffles_rows_once(spark):
    """Rows go straight to their tasks: one exchange of a stated number of partitions."""
    plan = models.spread(sample(spark), FOREST, ["trip_distance"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
