"""The month cursor, kept as an append-only ledger of finished months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.schemas import BATCH_LEDGER
from faregauge.sources.files import empty_table, path_exists

FIRST_MONTH = date(2025, 1, 1)
LAST_MONTH = date(2025, 6, 1)


def read_months(spark: SparkSession, ledger: str) -> DataFrame:
    """Finished months; empty before the first one."""
    if not path_exists(spark, ledger):
        return empty_table(spark, BATCH_LEDGER)
    return spark.read.schema(BATCH_LEDGER).parquet(ledger)


def next_batch_month(
    finished: DataFrame, first: date = FIRST_MONTH, last: date = LAST_MONTH
) -> DataFrame:
    """The month after the last finished one, as a single row.

    ``add_months`` takes care of the turn of the year. Past the last month the
    row is not valid and names none.
    """
    following = F.add_months(F.max("batch_month"), 1)
    row = finished.agg(
        F.coalesce(following, F.lit(first)).alias("due"), F.count("*").alias("total_processed")
    )
    due, valid = F.col("due"), F.col("due") <= F.lit(last)
    done = f"All batches completed (up to {last.month}/{last.year})"
    reason = F.when(valid, F.concat(F.lit("Processing batch: "), F.date_format(due, "MM/yyyy")))
    return row.select(
        F.when(valid, F.month(due)).alias("month"),
        F.when(valid, F.year(due)).alias("year"),
        valid.alias("is_valid"),
        reason.otherwise(done).alias("reason"),
        "total_processed",
    )


def month_bounds(year: Column, month: Column) -> list[Column]:
    """First and last day of a month."""
    first = F.make_date(year, month, F.lit(1))
    return [first.alias("start_date"), F.last_day(first).alias("end_date")]


def batch_date_range(batches: DataFrame) -> DataFrame:
    """Date range of every (year, month) row."""
    return batches.select("year", "month", *month_bounds(F.col("year"), F.col("month")))


def mark_batch_complete(spark: SparkSession, ledger: str, month: date) -> None:
    """Record a finished month; called only after its tables are written."""
    entry = spark.createDataFrame([(month,)], "batch_month date")
    entry.withColumn("completed_at", F.current_timestamp()).write.mode("append").parquet(ledger)


def reset_batches(spark: SparkSession, ledger: str) -> None:
    """Start over with an empty ledger."""
    empty_table(spark, BATCH_LEDGER).write.mode("overwrite").parquet(ledger)
