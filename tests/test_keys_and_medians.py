"""Dense keys, even sorts and exact medians, on skewed data too."""

import random
import statistics

import pytest
from conftest import values
from pyspark.sql import functions as F

from faregauge.operators import keys
from faregauge.operators.features import impute_median, sample_cap
from faregauge.operators.medians import exact_medians


def stored(spark, frame, path):
    frame.repartition(5).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_dense_key_equals_global_row_number(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("a"), F.lit("x").alias("b"))
    table = stored(spark, rows, tmp_path / "in")
    keyed = keys.dense_key(table, ["a"], "k", str(tmp_path / "staged"))
    assert values(keyed.orderBy("k"), "k", "a") == [
        (i, a) for i, (a,) in enumerate(sorted(values(rows, "a")), 1)
    ]


def test_copies_spread_over_ranges(spark, tmp_path):
    """A third of all rows are equal: they must not end up in one task."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5000).otherwise(F.col("id")).alias("a"))
    table = stored(spark, rows, tmp_path / "in")
    keys.stage_ordered(table, ["a"], str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    keyed = keys.numbered(staged, keys.key_offsets(staged, ["part_no"]), ["part_no"], "k")
    assert values(keyed.agg(F.min("k"), F.max("k"), F.count_distinct("k"))) == [(1, 9000, 9000)]
    assert [a for (a,) in values(keyed.orderBy("k"), "a")] == sorted(a for (a,) in values(rows))


def test_sorted_evenly_splits_a_hot_key(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = keys.sorted_evenly(rows, F.col("a")).groupBy(F.spark_partition_id()).count()
        assert parts.agg(F.max("count")).first()[0] < 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_touched_partitions_only(spark, make, tmp_path):
    path = str(tmp_path / "t")
    keys.stage_ordered(make([("a", 1), ("b", 2), ("b", 3)], "m string, v int"), ["v"], path, "m")
    keys.stage_ordered(make([("b", 9)], "m string, v int"), ["v"], path, "m", touched_only=True)
    staged = spark.read.parquet(path)
    offsets = keys.key_offsets(staged, ["m", "part_no"])
    keyed = keys.numbered(staged, offsets, ["m", "part_no"], "k")
    assert sorted(values(keyed, "k", "m", "v")) == [(1, "a", 1), (2, "b", 9)]


def test_broadcast_only_below_the_limit(spark):
    small, large = spark.range(5), spark.range(50)
    plan = lambda t: t._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(keys.broadcast_if_small(small, 10))
    assert "broadcast" not in plan(keys.broadcast_if_small(large, 10))


@pytest.mark.parametrize("seed", range(4))
def test_medians_against_brute_force(spark, seed):
    dice = random.Random(seed)
    columns = {
        "even": [dice.gauss(0, 1) for _ in range(1000)],
        "heavy": [dice.paretovariate(0.3) for _ in range(999)] + [None],
        "hot": [7.0] * 400 + [dice.uniform(-1e9, 1e9) for _ in range(600)],
        "few": [float(dice.choice([1, 2])) for _ in range(1000)],
        "none": [None] * 1000,
    }
    rows = list(zip(*columns.values(), strict=True))
    table = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    expected = {
        c: statistics.median(known) if (known := [x for x in v if x is not None]) else None
        for c, v in columns.items()
    }
    assert exact_medians(table, list(columns)) == expected


def test_medians_when_the_percentiles_miss(spark, monkeypatch):
    """The bracket is only a guess; a wrong one costs a pass, not the result."""
    table = spark.range(1, 1002).select(F.col("id").cast("double").alias("x"))
    for wrong in ([-5.0, -4.0], [2000.0, 3000.0], [1.0, 2.0], [900.0, 901.0]):
        guess = F.array(*map(F.lit, wrong))
        with monkeypatch.context() as patch:
            patch.setattr(
                "faregauge.operators.medians.F.percentile_approx", lambda *_: F.max(guess)
            )
            assert exact_medians(table, ["x"]) == {"x": 501.0}


def test_impute_median(make):
    rows = make([("1", None), ("2", None), (None, None), ("bad", None)], "a string, b double")
    assert values(impute_median(rows, ["a", "b"])) == [(1.0, None), (2.0, None), (1.5, None), (1.5, None)]


def test_sample_cap_keeps_the_lowest_draws(spark):
    rows = spark.range(1, 5001).select(F.col("id").alias("feature_id"))
    sample = [k for (k,) in values(sample_cap(rows, 300))]
    import hashlib

    ranked = sorted(range(1, 5001), key=lambda k: hashlib.md5(f"{k}:42".encode()).hexdigest())
    assert sorted(sample) == sorted(ranked[:300])
    assert sample_cap(rows, 5000).count() == 5000


def test_first_rows_after_an_earlier_range_shrank(spark, make, tmp_path):
    """A place within its range may exceed the key once ranges before it have shrunk."""
    path = str(tmp_path / "staged")
    make([("a", 0, 0, "x"), ("b", 0, 7, "y"), ("b", 0, 8, "z")], "m string, part_no int, row_no long, v string").write.parquet(path)
    staged = spark.read.parquet(path)
    offsets = keys.key_offsets(staged, ["m", "part_no"])
    rows = keys.first_numbered(staged, offsets, ["m", "part_no"], "k", 2).collect()
    assert sorted((r.k, r.v) for r in rows) == [(1, "x"), (2, "y")]


def test_medians_end_on_nan_and_infinity(make):
    nan, inf = float("nan"), float("inf")
    cases = [[1.0, 2.0, 3.0, nan, nan, nan], [1.0, 2.0, 3.0, inf, inf, inf], [-inf, -inf, 5.0], [-1.7e308, 1.7e308, 5e-324], [nan]]
    for case in cases:
        numbers = sorted(x for x in case if x == x)
        low, high = (numbers[(len(numbers) - 1) // 2], numbers[len(numbers) // 2]) if numbers else (None, None)
        wanted = None if not numbers else (low + high) / 2
        assert exact_medians(make([(x,) for x in case], "v double"), ["v"]) == {"v": wanted}
