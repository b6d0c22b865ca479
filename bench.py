"""Times the end-to-end queries on stored input tables and prints one JSON line.

Stand-in tables are written once per run, as the queries read stored tables. Each query runs
once to warm up and then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.params import (
    CANCELLED_AFTER,
    DAILY_AS_OF,
    DAILY_CUTOFF,
    DEMANDED_AFTER,
    HOURLY_AS_OF,
    HOURLY_CUTOFF,
)
from demandspark.operators.curves import daily_demand
from demandspark.operators.geometry import delaunay_triangles, ring_vertices
from demandspark.plans import daily, forecasts, hourly, studies
from demandspark.session import build_session
from demandspark.sources import scratch, standins


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", int(cpus), os.environ.get("BENCH_MEMORY", "12g"))

    def stored(name: str):
        return scratch.materialize(getattr(standins, name)(spark, folder), name)

    past, rides, simul, simul_past = map(
        stored, ("past_forecasts", "rides", "simul_rides", "simul_past_forecasts")
    )
    forecast, rings = stored("forecast"), stored("polygons")
    orc = scratch.scratch_path(spark, "baseline-orc")
    standins.baseline(spark, folder).write.orc(orc)

    def full():
        return daily.full_training_set(past, rides, DAILY_CUTOFF, DAILY_AS_OF, CANCELLED_AFTER)

    def by_hour():
        return hourly.hourly_training_set(
            simul_past, simul, HOURLY_AS_OF, HOURLY_CUTOFF, CANCELLED_AFTER
        )

    training, training_by_hour = scratch.materialize(full(), "daily"), scratch.materialize(by_hour(), "hourly")
    queries = {
        "moving_average_forecast": lambda: forecasts.moving_average_forecast(forecast),
        "exponential_smoothing_forecast": lambda: forecasts.exponential_smoothing_forecast(forecast),
        "five_factor_training_set": lambda: daily.five_factor_training_set(past, DAILY_CUTOFF),
        "full_training_set": full,
        "hourly_training_set": by_hour,
        "first_daily_study": lambda: studies.first_daily_study(training),
        "second_daily_study": lambda: studies.second_daily_study(training),
        "third_daily_study": lambda: studies.third_daily_study(training),
        "hourly_study": lambda: studies.hourly_study(training_by_hour, hourly.PROFILE_COLUMNS),
        "city_models": lambda: studies.city_models(training),
        "latest_baseline": lambda: forecasts.latest_baseline(spark, orc),
        "daily_demand": lambda: daily_demand(rides, DEMANDED_AFTER),
        "delaunay_triangles": lambda: delaunay_triangles(ring_vertices(rings)),
    }
    times = {}
    for name, query in queries.items():
        taken = []
        for _ in range(runs + 1):
            start = time.time()
            query().write.format("noop").mode("overwrite").save()
            taken.append(time.time() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_end_to_end_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
