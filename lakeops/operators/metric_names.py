"""Dotted metric names to a name and labels, by ordered wildcard rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class NameRule:
    """``*`` in ``match`` stands for one dot-free part, ``$n`` for what it matched."""

    match: str
    name: str
    labels: Mapping[str, str] = field(default_factory=dict)

    @property
    def pattern(self) -> str:
        parts = [re.escape(p) for p in self.match.split("*")]
        return "^" + "([^.]*)".join(parts) + "$"


_DAG_RUN = {"dag_id": "$1", "run_id": "$2"}
_TASK = {"dag_id": "$1", "task_id": "$2", "run_id": "$3"}

# Scheduler metric names, most specific first, catch-all last
SCHEDULER_RULES = (
    NameRule("airflow.dagrun.*.*.duration", "airflow_dagrun_duration", _DAG_RUN),
    NameRule("airflow.dagrun.*.*.success", "airflow_dagrun_success", _DAG_RUN),
    NameRule("airflow.dagrun.*.*.failed", "airflow_dagrun_failed", _DAG_RUN),
    NameRule("airflow.task.*.*.*.duration", "airflow_task_duration", _TASK),
    NameRule("airflow.task.*.*.*.success", "airflow_task_success", _TASK),
    NameRule("airflow.task.*.*.*.failed", "airflow_task_failed", _TASK),
    NameRule("airflow.scheduler.heartbeat", "airflow_scheduler_heartbeat"),
    NameRule("airflow.scheduler.tasks.running", "airflow_scheduler_tasks_running"),
    NameRule("airflow.scheduler.tasks.starving", "airflow_scheduler_tasks_starving"),
    NameRule("airflow.scheduler.tasks.executable", "airflow_scheduler_tasks_executable"),
    NameRule("airflow.executor.open_slots", "airflow_executor_open_slots"),
    NameRule("airflow.executor.queued_tasks", "airflow_executor_queued_tasks"),
    NameRule("airflow.executor.running_tasks", "airflow_executor_running_tasks"),
    NameRule("airflow.pool.open_slots.*", "airflow_pool_open_slots", {"pool": "$1"}),
    NameRule("airflow.pool.used_slots.*", "airflow_pool_used_slots", {"pool": "$1"}),
    NameRule("airflow.dag_processing.total_parse_time", "airflow_dag_processing_total_parse_time"),
    NameRule(
        "airflow.dag_processing.last_duration.*",
        "airflow_dag_processing_last_duration",
        {"dag_file": "$1"},
    ),
    NameRule("airflow.ti.*.*.*.*.duration", "airflow_ti_duration", {**_TASK, "try_number": "$4"}),
    NameRule("airflow.*", "airflow_${1}", {"type": "${1}"}),
)

_REFERENCE = re.compile(r"\$\{?(\d+)\}?")


def map_metric_names(
    df: DataFrame, name_col: str, rules: Sequence[NameRule] = SCHEDULER_RULES
) -> DataFrame:
    """Add ``metric``, ``labels`` and ``matched``; the first matching rule wins.

    A name no rule knows keeps its text with other characters made underscores.
    """
    raw = F.col(name_col)
    no_labels = F.create_map().cast("map<string,string>")
    unknown = F.struct(
        F.regexp_replace(raw, r"[^a-zA-Z0-9_:]", "_").alias("metric"),
        no_labels.alias("labels"),
        F.lit(False).alias("matched"),
    )
    chosen: Column | None = None
    for rule in rules:
        hit = F.struct(
            _fill(rule.name, raw, rule.pattern).alias("metric"),
            _labels(rule, raw, no_labels).alias("labels"),
            F.lit(True).alias("matched"),
        )
        applies = raw.rlike(rule.pattern)
        chosen = F.when(applies, hit) if chosen is None else chosen.when(applies, hit)
    chosen = unknown if chosen is None else chosen.otherwise(unknown)
    mapped = df.withColumn("_mapped", chosen)
    return mapped.select(*df.columns, "_mapped.metric", "_mapped.labels", "_mapped.matched")


def _fill(template: str, raw: Column, pattern: str) -> Column:
    """Expand ``$n`` from the groups of ``pattern``; a plain text is a literal."""
    pieces, at = [], 0
    for found in _REFERENCE.finditer(template):
        pieces.append(F.lit(template[at : found.start()]))
        pieces.append(F.regexp_extract(raw, pattern, int(found.group(1))))
        at = found.end()
    pieces.append(F.lit(template[at:]))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def _labels(rule: NameRule, raw: Column, no_labels: Column) -> Column:
    if not rule.labels:
        return no_labels
    pairs = []
    for key, template in rule.labels.items():
        pairs += [F.lit(key), _fill(template, raw, rule.pattern)]
    return F.create_map(*pairs)
