"""Ranges of a sort by time with bounds and sizes counted beforehand.

One histogram of rows per minute says where every range begins, which task gets it and what
number its first row has. So the rows are shuffled once, straight to their range, without a
sample of them and without counting them when they are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregauge.functions import calendar
from faregauge.operators.keys import offsets_of

# Rows a range has at most, but for its last minute.
RANGE_ROWS = 2_000_000
MINUTES = 1_100_000
# Rows looked at per range when a single minute has to be cut.
SAMPLED = 60
_ROW_BITS = 33
_LAST = 1 << 60


def minute(moment: Column) -> Column:
    """Minutes since 1970 of a moment; rows without one come last."""
    return F.coalesce(F.floor(F.unix_seconds(moment.cast("timestamp")) / 60), F.lit(_LAST))


@dataclass(frozen=True)
class CountedRanges:
    """The range of every minute, the number of ranges, and their offsets.

    ``cells`` has (cell, part, part_no, cuts): ``cuts`` divide a minute that is larger than a
    range. Then the sizes of its pieces aren't known and ``offsets`` is None.
    """

    moment: str
    order: tuple[str, ...]
    part: str
    cells: DataFrame
    minutes: int
    count: int
    offsets: DataFrame | None

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` in order, with ``part``, ``part_no`` and ``row_no``.

        The minutes, which were counted, are broadcast up to ``MINUTES``, two years of them;
        beyond that the planner shuffles.
        """
        cells = F.broadcast(self.cells) if self.minutes <= MINUTES else self.cells
        keyed = rows.withColumn("_cell", minute(F.col(self.moment))).join(cells, "_cell")
        if self.offsets is None:
            passed = F.size(F.filter("_cuts", lambda cut: cut <= _comparable(self.order)))
            keyed = keyed.withColumn("part_no", F.col("part_no") + F.coalesce(passed, F.lit(0)))
        sent = keyed.drop("_cell", "_cuts").repartitionById(max(self.count, 1), F.col("part_no"))
        return sent.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in self.order]).withColumn(
            "row_no", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
        )


def _comparable(order: Sequence[str]) -> Column:
    """A struct that compares as a sort with nulls last does; an id parts equal rows."""
    pairs = [c for i, name in enumerate(order) for c in (F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"c{i}"))]
    return F.struct(*pairs, F.monotonically_increasing_id().alias("tie"))


def _cuts(rows: DataFrame, order: Sequence[str], crowded: dict[int, int], sizes: dict[int, int]) -> DataFrame:
    """(cell, cuts) of minutes with more rows than a range, from a sample of these alone.

    As many rows come to the driver as a range sort would sample: ``SAMPLED`` per range.
    """
    own = rows.withColumn("_cell", minute(F.col(order[0])))
    drawn = [
        own.where(F.col("_cell") == cell).sample(fraction=min(1.0, SAMPLED * (pieces + 1) / sizes[cell]), seed=cell % 1000)
        for cell, pieces in crowded.items()
    ]
    keys = reduce(DataFrame.unionByName, drawn).select("_cell", _comparable(order).alias("key"))
    ranked = keys.groupBy("_cell").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    pieces = rows.sparkSession.createDataFrame(list(crowded.items()), "_cell long, _pieces int")
    at = F.transform(
        F.sequence(F.lit(1), "_pieces"),
        lambda i: F.get("keys", F.least(F.floor(i * F.size("keys") / (F.col("_pieces") + 1)), F.size("keys") - 1).cast("int")),
    )
    return ranked.join(pieces, "_cell").select("_cell", at.alias("_cuts"))


def counted_ranges(
    rows: DataFrame, order: Sequence[str], part: str, path: str, ranges: int, range_rows: int = RANGE_ROWS
) -> CountedRanges:
    """Ranges for ``rows`` sorted by ``order``, whose first column is a moment.

    No range goes over the end of a month, the value of column ``part``. There are at least
    ``ranges`` of them if rows suffice. The window runs over the minutes of a month and
    one row per month comes to the driver, which the calendar bounds.
    """
    spark = rows.sparkSession
    moment = order[0]
    rows.groupBy(minute(F.col(moment)).alias("_cell")).agg(F.count("*").alias("_n")).write.parquet(f"{path}/minutes")
    counts = spark.read.schema("_cell long, _n long").parquet(f"{path}/minutes")
    label = F.when(F.col("_cell") < _LAST, calendar.month_label(F.timestamp_seconds(F.col("_cell") * 60)))
    labelled = counts.withColumn(part, label)
    # One row per month, so the bases of their ranges are added up here.
    months = labelled.groupBy(part).agg(F.sum("_n").alias("n"), F.count("*").alias("minutes")).collect()
    total = sum(m["n"] for m in months)
    width = max(1, min(range_rows, -(-total // max(ranges, 1))))
    bases, count = [], 0
    for month in sorted(months, key=lambda m: (m[part] is None, m[part] or "")):
        bases.append((month[part], count))
        count += -(-month["n"] // width)
    so_far = Window.partitionBy(part).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = labelled.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
    first, last = F.floor(F.col("_before") / width), F.floor((F.col("_before") + F.col("_n") - 1) / width)
    base = spark.createDataFrame(bases, "_part string, _base long")
    located = before.join(F.broadcast(base), F.col(part).eqNullSafe(F.col("_part"))).select(
        "_cell", part, "_n", (F.col("_base") + first).cast("int").alias("part_no"), (last - first).cast("int").alias("_pieces")
    )
    located.write.parquet(f"{path}/cells")
    cells = spark.read.schema(located.schema).parquet(f"{path}/cells")
    minutes = sum(m["minutes"] for m in months)
    large = cells.where(F.col("_n") > width).select("_cell", "_pieces", "_n").collect()
    if not large:
        sizes = cells.groupBy(part, "part_no").agg(F.sum("_n").alias("_n"), F.lit(0).cast("long").alias("_first"))
        plain = cells.select("_cell", part, "part_no", F.lit(None).alias("_cuts"))
        return CountedRanges(moment, tuple(order), part, plain, minutes, count, offsets_of(sizes, [part, "part_no"]))
    crowded = {row["_cell"]: row["_pieces"] for row in large}
    cuts = _cuts(rows, order, crowded, {row["_cell"]: row["_n"] for row in large})
    cut = cells.select("_cell", part, "part_no").join(cuts, "_cell", "left")
    cut.write.parquet(f"{path}/cuts")
    return CountedRanges(moment, tuple(order), part, spark.read.schema(cut.schema).parquet(f"{path}/cuts"), minutes, count, None)
