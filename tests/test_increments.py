"""State over streams, bucketed keys, sketches, nested records, catch-up, agreement, SQL functions."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from lakeops.functions.sql import register_functions
from lakeops.operators import annotations as an, lineage, metrics, nested, rules as r, sketches
from lakeops.sources import daily, layers
from lakeops.sources.key_index import KeyIndex
from lakeops.streaming.counters import counter_steps
from lakeops.streaming.ingest import indexed_handler
from lakeops.streaming.repeats import drop_repeats
from lakeops.streaming.watch import ProgressSamples
from tests.helpers import AS_OF, at, plan, rows, sales

READING = "series string, ts timestamp, n bigint, value double"


def feed(spark, path, batches, schema, make, name="out"):
    """Run ``make`` over a stream whose files come batch by batch; the table it wrote, the queries."""
    queries, out = [], None
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{path}/{name}-in")
        out = make(spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(f"{path}/{name}-in"))
        writer = out.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/{name}-c")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        queries.append(query)
    return spark.read.schema(out.schema).parquet(f"{path}/{name}"), queries


def state_rows(query):
    return sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])


def minute(m):
    return at(f"2024-01-{1 + m // 1440:02d} {m // 60 % 24:02d}:{m % 60:02d}:00")


def test_counter_steps_equal_the_batch_form(spark, path):
    rng, readings, counters = random.Random(1), [], {}
    for i in range(600):
        s = rng.choice("ab" * 3 + "c")
        counters[s] = 0.0 if rng.random() < 0.05 else counters.get(s, 0.0) + rng.randint(0, 9)
        readings.append((s, minute(i // 2), i, counters[s] if rng.random() > 0.02 else None))
    batches = [readings[i : i + 100] for i in range(0, 600, 100)]
    for a, b in zip(batches, batches[1:]):  # the last readings of a batch come with the next one
        late = rng.sample(a[70:100], 10)
        b += late
        a[:] = [x for x in a if x not in late]
        rng.shuffle(a)
    steps, _ = feed(spark, path, batches, READING, lambda s: counter_steps(s, "ts", "value", ["series"], ["n"], "30 minutes", "10 days"))
    want = metrics.counter_rate(spark.createDataFrame(readings, READING), "ts", "value", ["series"], 60, ["n"])
    until = minute(299 - 30)
    want = {(w["series"], w["window_start"]): w["increase"] for w in want.collect() if w["window_start"] < until}
    got = {}
    for s in steps.where(F.col("ts") < F.lit(until)).collect():
        got[s["series"], s["ts"]] = got.get((s["series"], s["ts"]), 0.0) + s["step"]
    assert got == want and len(got) > 200


def test_idle_series_are_forgotten(spark, path):
    batches = [
        [("a", minute(0), 0, 5.0), ("b", minute(1), 0, 1.0)],
        [("b", minute(200), 1, 4.0)],
        [("b", minute(210), 2, 6.0), ("a", minute(215), 3, 9.0)],
        [("b", minute(400), 4, 7.0)],
    ]
    make = lambda s: counter_steps(s, "ts", "value", ["series"], ["n"], "10 minutes", "1 hour")
    steps, queries = feed(spark, path, batches, READING, make)
    # a is gone when its next reading comes; b's came before the watermark could tell that it was idle
    assert rows(steps, "series", "step") == [("a", 0.0), ("a", 0.0), ("b", 0.0), ("b", 2.0), ("b", 3.0)]
    assert state_rows(queries[1]) == 1  # a has gone
    assert state_rows(queries[3]) == 1


def test_counter_of_null_readings(spark, path):
    batches = [[("a", None, 0, 1.0), ("a", minute(1), 1, None), (None, minute(1), 1, 2.0), (None, minute(2), 1, 5.0)], [("z", minute(99), 1, 1.0)]]
    steps, _ = feed(spark, path, batches, READING, lambda s: counter_steps(s, "ts", "value", ["series"], [], "10 minutes"))
    assert rows(steps, "series", "step") == [(None, 0.0), (None, 3.0)]


EVENT = "id string, ts timestamp, word string"


def test_copies_in_other_batches(spark, path):
    batches = [
        [("a", minute(0), "first"), ("a", minute(0), "first"), ("b", minute(5), "b")],
        [("c", minute(20), "c")],
        [("a", minute(0), "first"), ("d", minute(30), "d")],  # two batches later
        [("e", minute(300), "e")],
        [("a", minute(0), "late"), ("a", minute(310), "new")],  # late, and after the watermark
    ]
    once, queries = feed(spark, path, batches, EVENT, lambda s: drop_repeats(s, ["id"], "ts", "60 minutes"))
    assert rows(once, "id", "word") == [("a", "first"), ("a", "new"), ("b", "b"), ("c", "c"), ("d", "d"), ("e", "e")]
    assert [state_rows(q) for q in queries] == [2, 3, 4, 1, 2]  # bounded by the keys of the span


def test_index_plan_leaves_stored_keys_in_place(spark, path):
    index = KeyIndex(spark, path + "/keys", "k", buckets=4)
    index.add(spark.createDataFrame([(f"k{i}",) for i in range(100)], "k string"), 0)
    new = spark.createDataFrame([("k1", 1), ("x", 2), (None, 3)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = index.fresh(new.repartition(3), 1)
        text = plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(found, "k") == [("x",), (None,)]
    joined = text[text.index("SortMergeJoin") :]
    stored = joined[joined.index("FileScan parquet") - 400 :]
    assert "Bucketed: true" in stored
    # one exchange by the key, that of the batch; none between the stored files and the join
    assert text.count("hashpartitioning(k") == 1


def test_index_grows_repeats_and_compacts(spark, path):
    index = KeyIndex(spark, path + "/keys", "k", "bigint", buckets=3)
    numbers = lambda a, b: spark.range(a, b).withColumnRenamed("id", "k")
    assert index.fresh(numbers(0, 5), 0).count() == 5  # nothing is stored yet
    for batch in range(4):
        index.add(numbers(batch * 10, batch * 10 + 15), batch)
    index.add(numbers(30, 45), 3)
    assert index.fresh(numbers(0, 50), 9).count() == 5
    assert index.fresh(numbers(0, 50), 3).count() == 15  # its own keys do not count
    assert index.files() > 3
    for _ in range(2):
        index.compact()
        assert index.files() == 3 and index.stored().count() == 45
    again = KeyIndex(spark, path + "/keys", "k", "bigint", buckets=3)
    assert rows(again.stored().where("k = 12")) == [(12, 0)]
    again.add(numbers(100, 101), 7)
    assert again.fresh(numbers(99, 102)).count() == 2


def test_repeated_batch_leaves_the_same(spark, path):
    index = KeyIndex(spark, path + "/keys", "transaction_id", buckets=2)
    handle = indexed_handler(path + "/silver", index, AS_OF, 50)
    first, second = sales(spark, {}, {}, {"quantity": 0}), sales(spark, {"transaction_id": "t1"}, {"transaction_id": "new"}, {"transaction_id": "new"})
    stored = lambda: rows(spark.read.parquet(path + "/silver"), "transaction_id", "batch")
    handle(first, 0)
    handle(second, 1)
    once = stored()
    assert [k for k, _ in once] == ["new", "t1", "t2"]
    handle(second, 1)
    handle(first, 0)
    assert stored() == once


def test_a_dated_indexed_batch_is_written_without_a_shuffle(spark, path, monkeypatch):
    def never(*_):
        raise AssertionError("not needed")

    monkeypatch.setattr("lakeops.sources.tables.balanced", never)
    handle = indexed_handler(path + "/silver", KeyIndex(spark, path + "/keys", "transaction_id", buckets=2), AS_OF, 50, "2024-05-10")
    handle(sales(spark, {}, {}), 0)
    handle(sales(spark, {}, {}, {}), 1)
    handle(sales(spark, {}, {}, {}), 1)
    assert rows(spark.read.parquet(path + "/silver"), "transaction_id", "batch") == [("t1", "0"), ("t2", "0"), ("t3", "1")]


def test_sketches(spark, path):
    df = spark.range(60_000).select(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 7 + 1).cast("string"), 2, "0")).alias("partition_date"),
        F.when(F.col("id") % 9 != 0, (F.col("id") * 7 % 20_011).cast("string")).alias("who"),
    )
    sketches.daily_sketches(df, "who").write.parquet(path + "/s")
    stored = spark.read.parquet(path + "/s")
    assert stored.count() == 7
    week = sketches.distinct_over(stored, F.lit("all")).collect()[0]
    exact = df.agg(F.count_distinct("who")).first()[0]
    assert week["rows"] == 60_000
    assert abs(week["distinct_values"] - exact) <= sketches.error_bound() * exact
    text = plan(sketches.distinct_over(stored, F.lit("all")))
    assert text.count("FileScan") == 1 and path in text
    few = spark.createDataFrame([("d", None), ("d", "a"), ("d", "a")], "partition_date string, who string")
    assert rows(sketches.distinct_over(sketches.daily_sketches(few, "who"), F.col("partition_date")), "rows", "distinct_values") == [(3, 1)]


def test_an_unlucky_period_is_well_within_the_bound(spark):
    """Of 1,500 periods of 8,000 values that with the largest error under 4,096 registers, 4.5 %."""
    df = spark.range(1401 * 8000, 1402 * 8000).select((F.col("id") % 7).cast("string").alias("partition_date"), "id")
    got = sketches.distinct_over(sketches.daily_sketches(df, "id"), F.lit("week")).first()["distinct_values"]
    assert abs(got - 8000) / 8000 <= sketches.error_bound() / 2
    assert sketches.error_bound() == pytest.approx(3 * 1.04 / 64)  # what it was with 4,096


def test_nested_completeness(spark):
    data = [
        '{"user": {"login": "a", "plan": {"name": ""}}, "n": 1, "list": [{"x": 1}]}',
        '{"user": {"login": null}, "n": ""}',
        '{"user": {"odd key.": {"deep": null}}}',
        '{"user": null}',
        '{"user": "text"}',
        "null",
    ]
    lines = [("s", '{"_airbyte_raw_id": "%d", "_airbyte_data": %s}' % (i, d)) for i, d in enumerate(data)] + [("s", '{"_airbyte_raw_id": null}')]
    env = nested.open_nested(spark.createDataFrame(lines, "stream string, value string"))
    got = {r["path"]: (r["parents"], r["absent"], r["nulls"], r["empty"], r["filled"]) for r in nested.completeness_by_path(env).collect()}
    want = {
        "list": (5, 4, 0, 0, 1),
        "n": (5, 3, 0, 1, 1),
        "user": (5, 0, 1, 0, 4),
        "user.login": (3, 1, 1, 0, 1),
        "user.odd key.": (3, 2, 0, 0, 1),
        "user.odd key..deep": (1, 0, 1, 0, 0),
        "user.plan": (3, 2, 0, 0, 1),
        "user.plan.name": (1, 0, 0, 1, 0),
    }
    assert got == want  # also below "user", which is text in one record
    same = env.where("raw_id IN ('0', '1', '2', '3')")
    assert len(nested.paths_of(same)) == len(want)
    assert rows(env, "raw_id", F.size("missing_fields").alias("m"))[-1] == (None, 2)
    assert nested.completeness_by_path(env.where("false")).count() == 0


def test_observed_counts(spark, path):
    raw = sales(spark, {}, {"quantity": 0}, {"transaction_id": "old"}, {"transaction_id": "n"})
    from lakeops.operators.silver import to_silver_schema

    typed = to_silver_schema(raw, "2024-05-10", AS_OF)
    rule_list = r.sales_rules(AS_OF)
    old = typed.where("transaction_id = 'old'")
    plans = []

    def store(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        df.write.parquet(path + "/s")

    counts = r.observed_funnel(typed, rule_list, old, "transaction_id", store)
    assert counts == r.funnel(typed, rule_list, old, "transaction_id").first().asDict()
    assert counts["records_written"] == spark.read.parquet(path + "/s").count()
    assert plans[0].count("CollectMetrics") == 3
    empty = r.observed_funnel(typed.where("false"), rule_list, None, "transaction_id", lambda df: df.write.parquet(path + "/e"))
    assert set(empty.values()) == {0}


def day(text):
    return at(text + " 00:00:00").date()


def test_missing_spans(spark):
    days = lambda *d: spark.createDataFrame([(day(f"2024-01-{x:02d}"),) for x in d], "day date")
    spans = daily.missing_spans(days(*range(1, 13), 5), days(1, 4, 5, 6, 12, 31))
    got = sorted((s["start"].day, s["after"].day, s["days"]) for s in spans.collect())
    assert got == [(2, 4, 2), (7, 12, 5)]
    assert daily.missing_spans(days(1), days(1)).count() == 0


def test_catch_up(spark, path):
    events = spark.createDataFrame([(i, at(f"2024-01-{1 + i % 9:02d} 10:00:00")) for i in range(90)], "id int, ts timestamp_ntz")
    load = lambda a, b: daily.catch_up(events, "ts", f"2024-01-{a:02d}", f"2024-01-{b:02d}", path + "/t", path + "/l")
    assert [tuple(x)[2:] for x in load(3, 4).collect()] == [(2, 20)]
    assert sorted(tuple(x)[2:] for x in load(1, 12).collect()) == [(2, 20), (8, 50)]  # the last three days are empty
    assert load(1, 12).count() == 0
    assert spark.read.parquet(path + "/t").count() == 90
    assert spark.read.parquet(path + "/l").count() == 12


def test_agreement_of_known_tables(spark):
    # Fleiss' own example: 14 raters, 10 items, 5 classes
    table = [
        (0, 0, 0, 0, 14), (0, 2, 6, 4, 2), (0, 0, 3, 5, 6), (0, 3, 9, 2, 0), (2, 2, 8, 1, 1),
        (7, 7, 0, 0, 0), (3, 2, 6, 3, 0), (2, 5, 3, 2, 2), (6, 5, 2, 1, 0), (0, 2, 2, 3, 7),
    ]
    given = [(i, c) for i, row in enumerate(table) for c, n in enumerate(row) for _ in range(n)]
    out = an.chance_corrected(an.class_counts(spark.createDataFrame(given, "i int, c int"), "i", "c")).first()
    assert out["items"] == 10 and out["annotations"] == 140
    assert round(out["fleiss_kappa"], 3) == 0.210
    # Krippendorff's example with missing annotations: nominal alpha 0.691 (computed by hand from its coincidences)
    units = "1_1 2222 3333 3333 2222 1234 4441 1121 2222 _555 __11".split()
    given = [(i, int(c) if c != "_" else None) for i, u in enumerate(units) for c in u]
    out = an.chance_corrected(an.class_counts(spark.createDataFrame(given, "i int, c int"), "i", "c")).first()
    assert out["krippendorff_alpha"] == pytest.approx(alpha(given), abs=1e-12)


def alpha(given):
    """Nominal alpha from the definition: pairs within items against pairs overall."""
    units = {}
    for i, c in given:
        if c is not None:
            units.setdefault(i, []).append(c)
    units = [u for u in units.values() if len(u) > 1]
    everything = [c for u in units for c in u]
    n = len(everything)
    observed = sum(sum(a != b for a in u for b in u) / (len(u) - 1) for u in units) / n
    expected = sum(a != b for a in everything for b in everything) / (n * (n - 1))
    return 1 - observed / expected


def test_agreement_without_disagreement(spark):
    of = lambda given: an.chance_corrected(an.class_counts(spark.createDataFrame(given, "i int, c int"), "i", "c")).first()
    same = of([(1, 1), (1, 1), (2, 1), (2, 1), (3, 1)])
    assert (same["items"], same["agreement"], same["fleiss_kappa"], same["krippendorff_alpha"]) == (2, 1.0, None, None)
    none = of([(1, 1), (2, None)])
    assert (none["items"], none["annotations"], none["krippendorff_alpha"]) == (0, 0, None)


def test_productivity_by_day(spark):
    df = spark.createDataFrame([("a", at("2024-01-01 01:00:00")), ("a", at("2024-01-01 02:00:00")), ("a", at("2024-01-03 01:00:00")), (None, None)], "who string, ts timestamp_ntz")
    got = sorted(((r["annotator"], str(r["day"]), r["annotations"], r["total"]) for r in an.productivity_by_day(df, "who", "ts").collect()), key=str)
    assert got == [("a", "2024-01-01", 2, 2), ("a", "2024-01-03", 1, 3), (None, "None", 1, 1)]


def test_progress_samples(spark, path):
    listener = ProgressSamples(spark, path + "/samples")
    spark.streams.addListener(listener)
    try:
        batches = [[("a", minute(0), "x"), ("b", minute(1), "y")], [("c", minute(2), "z")]]
        feed(spark, path, batches, EVENT, lambda s: drop_repeats(s, ["id"], "ts"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    stored = spark.read.schema("ts timestamp, name string, labels map<string,string>, value double").parquet(path + "/samples")
    seen = stored.where("name = 'pipeline_batch_rows' AND value > 0").select(F.col("labels")["batch"].alias("batch"), "value")
    assert sorted(v for _, v in rows(seen)) == [1.0, 2.0]
    assert stored.where("name = 'pipeline_batch_seconds' AND value > 0").count() >= 2
    assert {n for (n,) in rows(stored.select("name").distinct())} == {"pipeline_batch_rows", "pipeline_batch_seconds", "pipeline_batch_backlog", "pipeline_state_rows"}


def test_sql_functions(spark):
    names = register_functions(spark, ((10, "gold"), (5, "silver")), "none")
    got = spark.sql(
        "SELECT half_up(2.345D, 2) a, half_up(-0.5D, 0) b, pct(1, 3) c, pct(1, 0) d, value_tier(7) e, value_tier(NULL) f,"
        " iso_time('2024-01-02T03:04:05.5Z') g, iso_time('20240102T030405') h, iso_time('yesterday') i, iso_time('2024-13-02T03:04:05') j,"
        " fill_in('Hi {{ name }}, {{name}} {{x}}', 'name', 'Al') k"
    )
    row = got.first()
    assert (row["a"], row["b"], row["c"], row["d"], row["e"], row["f"]) == (2.35, 0.0, 33.33, None, "silver", "none")
    assert str(row["g"]) == "2024-01-02 03:04:05.500000" and str(row["h"]) == "2024-01-02 03:04:05" and row["i"] is None and row["j"] is None
    assert row["k"] == "Hi Al, Al {{x}}"
    assert "half_up" in names
    with layers.batch_view(spark.range(9).select(F.col("id").cast("double").alias("v"))) as view:
        text = plan(spark.sql(f"SELECT half_up(v / 3, 1), value_tier(v) FROM {view}"))
    assert "Python" not in text and "half_up" not in text.split("Project")[1].split("AS")[0]


def test_recursive_lineage(spark):
    jobs = [("t1", ["a"], ["b", "c"]), ("t2", ["b"], ["d"]), ("t3", ["c", "d"], ["e"]), ("t4", ["e"], ["a"]), ("t5", ["z"], ["y"])]
    edges = lineage.lineage_edges(lineage.declare(spark, jobs))
    for start, direction in (("a", "downstream"), ("e", "upstream"), ("nowhere", "downstream")):
        want = rows(lineage.lineage_impact(edges, start, direction), "dataset", "depth")
        assert rows(lineage.lineage_closure(edges, start, direction), "dataset", "depth") == want
    assert rows(lineage.lineage_closure(edges, "a", max_depth=1), "dataset") == [("b",), ("c",)]
