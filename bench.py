"""Times the pipeline stages and the reports; prints one JSON line.

Stages write their tables into a fresh folder in every round, reports read the
stored tables and are written to the no-op sink. The first round warms up the JVM
and is reported as ``first_round``; ``queries`` holds the best of the later ones.

The ``month_`` stages run on one month of at least 3,475,226 raw trips, the size
of the only run with published timings: the given trips, repeated and moved into one
January.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.operators import features
from faregauge.plans import models, quality, reports
from faregauge.plans.star import StarSchema, TableStore
from faregauge.session import local_session, shared_dir
from faregauge.sources.sinks import write_mart
from faregauge.testbed.registry import FILTER
from faregauge.testbed.tables import RULES, WINDOW
from faregauge.testbed.workspace import FORESTS, Workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
MONTH_ROWS = 3_475_226


def stages(space: Workspace) -> dict:
    """Pipeline stages in dependency order; each writes what it makes."""
    star = space.star
    return {
        "load_trips": space.trips,
        "load_weather": space.weather_daily,
        "clean_transform": star.cleaned,
        "weather_transform": star.weather,
        "dim_time": star.dim_time,
        "dim_location": star.dim_location,
        "dim_weather": star.dim_weather,
        "fact_trips": star.fact,
        "features": star.features,
    }


def looks(space: Workspace) -> dict:
    """Reports and audits on the stored tables."""
    star = space.star
    fact, places, times, skies = star.fact_rows(), star.dim_location(), star.dim_time(), star.dim_weather()
    raw = space.trips()
    result = {
        name: lambda name=name: getattr(reports, name)(fact, WINDOW)
        for name in dir(reports)
        if name[0] == "a" and name[1:3].isdigit() and name not in ("a11_borough_weather", "a12_top_zones", "a13_borough", "a14_map")
    }
    for name in ("a11_borough_weather", "a12_top_zones", "a13_borough", "a14_map"):
        result[name] = lambda name=name: getattr(reports, name)(fact, places, WINDOW)
    for name in ("d_overview", "d_map", "d_borough", "d_top_zones", "d_weather_summary", "d_hourly", "d_peak"):
        result[name] = lambda name=name: getattr(reports, name)(fact, places, FILTER)
    return result | {
        "q_day_of_week": lambda: reports.q_day_of_week(fact, times),
        "q_peak": lambda: reports.q_peak(fact),
        "q_weather_top10": lambda: reports.q_weather_top10(fact, skies),
        "q_top_locations": lambda: reports.q_top_locations(fact, places),
        "q_revenue": lambda: reports.q_revenue(fact, times),
        "q_daily_stats": lambda: reports.q_daily_stats(fact, times),
        "s_schema_summary": lambda: quality.s_schema_summary(fact, times, places, skies),
        "s_clean_report": lambda: quality.s_clean_report(raw, RULES),
        "dq_anomalies": lambda: quality.dq_anomalies(raw),
        "dq_fk": lambda: quality.fk_integrity(raw, places),
        "dq_money_summary": lambda: quality.dq_money_summary(raw),
        "dq_logic_evidence": lambda: quality.dq_logic_evidence(raw),
        "split_train_test": lambda: features.split_train_test(star.features()),
    }


def run(space: Workspace, root: str) -> dict[str, float]:
    took = {}
    for name, make in stages(space).items():
        start = time.perf_counter()
        make()
        took[name] = time.perf_counter() - start
    for name, make in looks(space).items():
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        took[name] = time.perf_counter() - start
    for name, make in month_stages(space, root).items():
        start = time.perf_counter()
        make()
        took[name] = time.perf_counter() - start
    return took


def training(space: Workspace) -> dict[str, float]:
    """Both forests at full size with their cross-validation, on stored features."""
    found = space.star.features()
    took = {}
    for forest in FORESTS:
        start = time.perf_counter()
        models.train(found, forest, space.model_path(forest))
        took[forest.name] = round(time.perf_counter() - start, 4)
    return took


def month_of_trips(space: Workspace) -> DataFrame:
    """The given trips as often as it takes, with all pickups in January 1997."""
    trips = space.trips()
    copies = -(-MONTH_ROWS // trips.count())
    start = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    offset = F.timestamp_diff("MINUTE", start, "tpep_pickup_datetime") + F.col("copy") * 61
    pickup = F.timestamp_add("MINUTE", F.pmod(offset, F.lit(31 * 1440)), start)
    ride = F.timestamp_diff("MINUTE", "tpep_pickup_datetime", "tpep_dropoff_datetime")
    return (
        trips.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumns({"_pickup": pickup, "_ride": ride})
        .withColumn("tpep_pickup_datetime", F.col("_pickup"))
        .withColumn("tpep_dropoff_datetime", F.timestamp_add("MINUTE", "_ride", F.col("_pickup")))
        .select(trips.columns)
    )


def month_stages(space: Workspace, root: str) -> dict:
    """The published stages in their order, on a month-sized table."""
    store = TableStore(space.spark, root)

    def raw() -> DataFrame:
        return store.table("raw", lambda path: write_mart(month_of_trips(space), path))

    star = StarSchema(store, raw, space.weather_daily, space.zones, RULES)

    def star_schema() -> None:
        star.dim_time(), star.dim_location(), star.dim_weather(), star.fact()

    def noop(frame: DataFrame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    return {
        "month_load": raw,
        "month_clean_transform": star.cleaned,
        "month_anomaly_counts": lambda: noop(quality.s_clean_report(raw(), RULES)),
        "month_weather": star.weather,
        "month_star_schema": star_schema,
        "month_summary": lambda: noop(
            quality.s_schema_summary(
                star.fact_rows(), star.dim_time(), star.dim_location(), star.dim_weather()
            )
        ),
        "month_borough_report": lambda: noop(
            reports.a11_borough_weather(star.fact_rows(), star.dim_location(), WINDOW)
        ),
    }


def main() -> None:
    spark = local_session(CPUS, "bench")
    base = f"{shared_dir(spark)}/bench"
    spaces = [Workspace(spark, SF_DIR, f"{base}-{i}") for i in range(ROUNDS)]
    rounds = [run(space, f"{base}-month-{i}") for i, space in enumerate(spaces)]
    best = {name: round(min(r[name] for r in rounds[1:] or rounds), 4) for name in rounds[0]}
    print(
        json.dumps(
            {
                "metric": "pipeline stages and reports, total of best rounds",
                "value": round(sum(best.values()), 4),
                "unit": "sec",
                "queries": best,
                # Once, and not in the total.
                "training": training(spaces[-1]),
                "first_round": {name: round(t, 4) for name, t in rounds[0].items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "rounds": ROUNDS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
