"""Places of rows within groups of any size, without gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregauge.llm.common import scratch
from faregauge.operators.keys import range_counts, stage_ordered


def places(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place (from 0) within ``group`` along ``order``, and ``size``.

    Nulls of ``order`` come first; ``group`` must not be null. Rows are range-sorted by group
    and order and written, so a group with most of all rows spreads over many tasks. Only
    counts per range and group are summed up afterwards. ``rows`` should be stored rows.
    """
    has = {f"_has_{c}": F.col(c).isNotNull() for c in order}
    keys = [group] + [k for c in order for k in (f"_has_{c}", c)]
    staged = stage_ordered(rows.withColumns(has), keys, scratch(rows.sparkSession, "places")).drop(*has)
    counts = range_counts(staged, ["part_no", group])
    before = Window.partitionBy(group).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "part_no",
        group,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_n").over(Window.partitionBy(group)).alias("size"),
    )
    joined = staged.join(starts, ["part_no", group])
    return joined.withColumn("pos", F.col("row_no") + F.col("_start")).drop("part_no", "row_no", "_start")
