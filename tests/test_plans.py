"""Plans must stay free of single-task exchanges and nested loops."""

import pytest

from checks.registry import QUERIES
from demandspark.operators import windows
from demandspark.operators.smoothing import ema
from demandspark.sources import scratch, standins, tables

PLANS = [
    "moving_average_forecast",
    "exponential_smoothing_forecast",
    "five_factor_training_set",
    "full_training_set",
    "full_training_set_with_averages",
    "hourly_training_set",
    "trailing_windows",
    "booking_curve",
    "demand_moving_averages",
    "slot_rolling_means",
]


@pytest.mark.parametrize("name", PLANS)
def test_no_single_partition_and_no_nested_loop(spark, folder, name):
    plan = QUERIES[name][0](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for bad in ("SinglePartition", "NestedLoop", "CartesianProduct"):
        assert bad not in plan


def test_ranged_plans_have_no_single_task_step(spark, folder):
    past = standins.past_forecasts(spark, folder).select(
        "city_destination", "delivery_date", "lead_time", "total_booked_cancelation_prediction"
    )
    city, value = ["city_destination"], "total_booked_cancelation_prediction"
    order = ["delivery_date", "lead_time"]
    plans = [
        windows.seq_num(past, city, order, strategy="ranged"),
        windows.rolling_mean(past, value, order, 6, city, strategy="ranged"),
        windows.running_sum(past, value, city, "delivery_date", strategy="ranged"),
        windows.prev_edge(past, "lead_time", city, strategy="ranged"),
        ema(past, value, 0.5, city, order, strategy="ranged"),
        windows.ranged_index(past, order),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("SinglePartition", "NestedLoop", "CartesianProduct"):
            assert bad not in plan


def test_cutoff_reaches_below_the_windows(spark, folder):
    plan = QUERIES["five_factor_training_set"][0](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Filter")


def test_smoothing_grid_shares_one_shuffle(spark, folder):
    past = scratch.materialize(standins.past_forecasts(spark, folder), "past")
    from demandspark.plans.daily import five_factor_training_set

    df = five_factor_training_set(past, "1995-01-31", strategy="window")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_daily_plans_are_built_without_a_job(spark, folder):
    from demandspark.plans.daily import five_factor_training_set, full_training_set

    past = scratch.materialize(standins.past_forecasts(spark, folder), "past")
    rides = scratch.materialize(standins.rides(spark, folder), "rides")
    context = spark.sparkContext
    context.setJobGroup("building", "plans")
    five_factor_training_set(past, "1995-01-31")
    full_training_set(past, rides, "1995-01-31", "2001-08-02")
    context.setJobGroup("done", "plans")
    assert not context.statusTracker().getJobIdsForGroup("building")


def test_hourly_set_scans_events_once_for_forecasts_and_once_for_the_curve(spark, folder):
    plan = QUERIES["hourly_training_set"][0](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 2 and "hourly-counts" in plan


def test_scan_reads_needed_columns_only(spark, folder):
    plan = QUERIES["daily_demand"][0](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {"spark.checkpoint.dir": setting}


def test_scratch_folder_comes_from_the_session(spark):
    stored = scratch.materialize(spark.range(5), "probe")
    assert stored.count() == 5
    assert scratch.scratch_root(spark).removeprefix("file:") in stored.inputFiles()[0]
    assert scratch.scratch_root(Session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    assert scratch.scratch_root(Session("yarn", None, "s3://z")) == "s3://z"
    assert "demandspark-" in scratch.scratch_root(Session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session("yarn"))


def test_training_set_round_trip_by_city(spark, folder, tmp_path):
    past = standins.past_forecasts(spark, folder)
    tables.write_training_set(past, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).select(*past.columns)
    assert back.exceptAll(past).count() == 0 and past.exceptAll(back).count() == 0
    assert any(p.name.startswith("city_destination=") for p in (tmp_path / "out").iterdir())


def test_to_local_is_bounded(spark):
    assert len(tables.to_local(spark.range(100), 7)) == 7


def test_csv_schema_is_inferred_on_request(spark, tmp_path):
    spark.range(3).selectExpr("id", "id / 2 AS half").write.option("header", True).csv(str(tmp_path / "c"))
    assert dict(tables.read_training_csv(spark, str(tmp_path / "c")).dtypes)["half"] == "double"


def test_copies_of_trailing_windows_are_not_shuffled(spark, folder):
    plan = QUERIES["slot_smoothed_profile"][0](spark, folder)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate")]  # the windows' copies are made here
    assert above.count("Exchange hashpartitioning") == 0 and "Window" in above


def test_full_training_set_scans_rides_once(spark, folder):
    from demandspark.plans.daily import full_training_set

    past = scratch.materialize(standins.past_forecasts(spark, folder), "past")
    rides = scratch.materialize(standins.rides(spark, folder), "rides")
    plan = full_training_set(past, rides, "1995-01-31", "2001-08-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # forecasts and rides
