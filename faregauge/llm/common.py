"""What the operators of this folder share: tables, stored intermediates, batches."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.llm.shingles import runs
from faregauge.session import configure, shared_dir

# Rows and bytes that go to a Python worker at once. Texts may be long, so the bytes
# bound the memory of a batch.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """The session with the settings that all operators here rely on."""
    configure(spark)
    for key, value in BATCH.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back.

    Cuts the lineage: an executor lost later costs a reread, and every use sees the
    same rows.
    """
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def anchored(rows: DataFrame) -> DataFrame:
    """``rows`` if they come straight from files, else a stored copy.

    Numbers given to rows by their place hold on a second reading only then.
    """
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    steps = [line.lstrip(" :+-|") for line in plan]
    plain = all(step.startswith(("Project", "Filter", "Relation")) for step in steps)
    return rows if plain else stored(rows, "rows")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def in_class(remainder: int, modulus: int, name: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as ''."""
    digits = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % modulus == remainder


def crc_class(number: int | None, modulus: int) -> int:
    """The remainder that ``in_class`` compares, outside Spark."""
    return zlib.crc32(b"" if number is None else str(number).encode()) % modulus


def by_batch(
    rows: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with something built once per task, such as a loaded model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield step(batch)

    return rows.mapInArrow(run, schema)


def by_run(
    rows: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``by_batch`` on runs of a batch's texts, each handed over before the next is begun.

    For steps that hold many times their texts: a worker keeps what its largest step took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start, stop in runs(batch.column("text")):
                yield step(batch.slice(start, stop - start))

    return rows.mapInArrow(run, schema)
