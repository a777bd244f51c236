import pytest
from pyspark.sql import functions as F

from lakeops.operators import metrics as m
from lakeops.operators.metric_names import NameRule, map_metric_names
from tests.helpers import at, rows

SAMPLES = "ts timestamp_ntz, s string, v double"


def counter(spark, *readings):
    return spark.createDataFrame([(at(f"2024-01-01 {t}"), s, v) for t, s, v in readings], SAMPLES)


def test_counter_rate_handles_restarts_and_window_borders(spark):
    df = counter(
        spark,
        ("10:00:00", "a", 10.0),  # first reading: nothing to compare with
        ("10:30:00", "a", 40.0),
        ("11:10:00", "a", 50.0),  # the step belongs to the window it is read in
        ("11:20:00", "a", 5.0),  # restart
        ("11:30:00", "a", 5.0),
        ("11:30:00", "b", 1.0),
        ("11:40:00", "b", None),
        ("11:50:00", "b", 3.0),
    )
    got = m.counter_rate(df, "ts", "v", ["s"], 3600)
    want = [
        ("a", at("2024-01-01 10:00:00"), 30.0, 30.0 / 3600),
        ("a", at("2024-01-01 11:00:00"), 15.0, 15.0 / 3600),
        ("b", at("2024-01-01 11:00:00"), 2.0, 2.0 / 3600),
    ]
    assert rows(got, "s", "window_start", "increase", "rate") == want
    total = m.counter_rate(df, "ts", "v", ["s"], 3600, by=[])
    assert rows(total, "window_start", "increase") == [
        (at("2024-01-01 10:00:00"), 30.0),
        (at("2024-01-01 11:00:00"), 17.0),
    ]


def test_gauge_latest_breaks_ties_and_maps(spark):
    df = counter(spark, ("10:00:00", "a", 1.0), ("11:00:00", "a", 0.0), ("09:00:00", "b", 1.0), ("09:30:00", "c", 7.0))
    got = m.gauge_latest(df, ["s"], value="v", mapping=m.UP_DOWN)
    assert rows(got, "s", "value", "state") == [("a", 0.0, "DOWN"), ("b", 1.0, "UP"), ("c", 7.0, None)]


def test_samples_and_layers(spark, path):
    reported = m.samples(
        spark,
        "2024-01-01 00:00:00",
        [
            (m.RECORDS_PROCESSED, {"layer": "silver", "table": "sales"}, 75),
            (m.RECORDS_PROCESSED, {"layer": "silver", "table": "sales"}, 5),
            (m.TABLE_ROWS, {"table_name": "t"}, 30),
        ],
    )
    m.append_samples(reported, path + "/m")
    m.append_samples(reported, path + "/m")
    got = m.records_by_layer(spark.read.parquet(path + "/m"))
    assert rows(got) == [("silver", "sales", 160.0)]


@pytest.mark.parametrize("n, colour", [(0, "green"), (1, "yellow"), (4, "yellow"), (5, "red")])
def test_failure_colours(spark, n, colour):
    df = spark.createDataFrame([("c", n)], "check_name string, failures long")
    assert m.failure_status(df).first()["colour"] == colour


def test_rates_and_outcomes(spark):
    df = counter(spark, ("10:00:00", "a", 1.0), ("10:01:00", "a", 3.0), ("11:00:00", "a", None))
    stage = m.mean_stage_duration(df, "s", "v").first()
    assert (stage["runs"], stage["total_seconds"], stage["mean_seconds"]) == (2, 4.0, 2.0)
    good = F.col("v") == 1.0
    pct = m.success_rate(df.where("v is not null"), "ts", good, 3600)
    assert rows(pct, "runs", "success_pct") == [(2, 50.0)]
    out = m.request_outcome(df, F.col("v") > 2).first()
    assert (out["requests"], out["errors"], out["successful"]) == (3, 1, 2)


# every rule of the fixed list, the catch-all, and names that match none
NAMES = {
    "airflow.dagrun.d.r.duration": ("airflow_dagrun_duration", {"dag_id": "d", "run_id": "r"}),
    "airflow.dagrun.d.r.success": ("airflow_dagrun_success", {"dag_id": "d", "run_id": "r"}),
    "airflow.dagrun.d.r.failed": ("airflow_dagrun_failed", {"dag_id": "d", "run_id": "r"}),
    "airflow.task.d.t.r.duration": ("airflow_task_duration", {"dag_id": "d", "task_id": "t", "run_id": "r"}),
    "airflow.task.d.t.r.success": ("airflow_task_success", {"dag_id": "d", "task_id": "t", "run_id": "r"}),
    "airflow.task.d.t.r.failed": ("airflow_task_failed", {"dag_id": "d", "task_id": "t", "run_id": "r"}),
    "airflow.scheduler.heartbeat": ("airflow_scheduler_heartbeat", {}),
    "airflow.scheduler.tasks.running": ("airflow_scheduler_tasks_running", {}),
    "airflow.scheduler.tasks.starving": ("airflow_scheduler_tasks_starving", {}),
    "airflow.scheduler.tasks.executable": ("airflow_scheduler_tasks_executable", {}),
    "airflow.executor.open_slots": ("airflow_executor_open_slots", {}),
    "airflow.executor.queued_tasks": ("airflow_executor_queued_tasks", {}),
    "airflow.executor.running_tasks": ("airflow_executor_running_tasks", {}),
    "airflow.pool.open_slots.p": ("airflow_pool_open_slots", {"pool": "p"}),
    "airflow.pool.used_slots.p": ("airflow_pool_used_slots", {"pool": "p"}),
    "airflow.dag_processing.total_parse_time": ("airflow_dag_processing_total_parse_time", {}),
    "airflow.dag_processing.last_duration.f": ("airflow_dag_processing_last_duration", {"dag_file": "f"}),
    "airflow.ti.d.t.r.2.duration": (
        "airflow_ti_duration",
        {"dag_id": "d", "task_id": "t", "run_id": "r", "try_number": "2"},
    ),
    "airflow.zombies": ("airflow_zombies", {"type": "zombies"}),
    "airflow.a.b": ("airflow_a_b", {}),
    "airflowXzombies": ("airflowXzombies", {}),
    "other-name": ("other_name", {}),
}


def test_metric_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "raw string")
    got = {r["raw"]: r for r in map_metric_names(df, "raw").collect()}
    assert {n: (r["metric"], r["labels"]) for n, r in got.items()} == NAMES
    unmatched = {n for n, r in got.items() if not r["matched"]}
    assert unmatched == {"airflow.a.b", "airflowXzombies", "other-name"}


def test_first_rule_wins(spark):
    df = spark.createDataFrame([("a.b",)], "raw string")
    rules = [NameRule("a.*", "first_${1}", {"x": "$1"}), NameRule("a.b", "second")]
    got = map_metric_names(df, "raw", rules).first()
    assert (got["metric"], got["labels"]) == ("first_b", {"x": "b"})
    assert map_metric_names(df, "raw", []).first()["metric"] == "a_b"
