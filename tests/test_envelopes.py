import json

from lakeops.operators import envelope_checks as ec
from lakeops.plans.gated import check_and_promote, run_gated_promotion
from lakeops.sources import envelopes as ev
from tests.helpers import plan, rows

AS_OF = "2024-05-10 12:00:00"


def line(raw_id="1", at="2024-05-10T10:00:00", data=None, drop=()):
    record = {
        ev.RAW_ID: raw_id,
        ev.EXTRACTED_AT: at,
        ev.DATA: {"a": "x"} if data is None else data,
    }
    return json.dumps({k: v for k, v in record.items() if k not in drop})


def opened(spark, *lines):
    df = spark.createDataFrame(list(lines), "stream string, value string")
    return ev.open_envelope(df)


def test_absent_null_and_empty_stay_apart(spark):
    env = opened(
        spark,
        ("s", line("1", data={"a": None, "b": ""})),
        ("s", line("2", data={"a": "x", "c": {"k": [1]}})),
        ("s", line("3", data={"a": ""})),
        ("s", line("4", data={"a": "y"})),
    )
    data = [r["data"] for r in env.orderBy("raw_id").collect()]
    assert data[0] == {"a": None, "b": ""}
    assert data[1] == {"a": "x", "c": '{"k":[1]}'}
    # c has no gap and is not listed; b is missing once, but only where it is present
    assert rows(ec.completeness(env)) == [
        ("s", "a", 2, 50.0, True),
        ("s", "b", 1, 75.0, True),
    ]


def test_completeness_warning_limit_is_strict(spark):
    lines = [("s", line(str(i), data={"a": "" if i == 0 else "x"})) for i in range(5)]
    assert rows(ec.completeness(opened(spark, *lines))) == [("s", "a", 1, 80.0, False)]


def test_missing_envelope_fields_and_duplicates(spark):
    env = opened(
        spark,
        ("a", line("1")),
        ("a", line("1")),
        ("a", line("2", drop=(ev.EXTRACTED_AT,))),
        ("a", line("3", drop=(ev.DATA,))),
        ("b", line(drop=(ev.RAW_ID,))),
        ("b", line(drop=(ev.RAW_ID,))),
        ("c", line("1")),
    )
    assert rows(ec.duplicate_ids(env)) == [("a", "1", 2), ("b", None, 2)]
    assert rows(ec.schema_violations(env), "stream", "raw_id", "missing_fields") == [
        ("a", "2", [ev.EXTRACTED_AT]),
        ("a", "3", [ev.DATA]),
        ("b", None, [ev.RAW_ID]),
        ("b", None, [ev.RAW_ID]),
    ]
    got = {r["stream"]: r for r in ec.quality_score(env).collect()}
    assert (got["a"]["schema_errors"], got["a"]["duplicate_ids"]) == (2, 1)
    assert got["a"]["quality_score"] == 25.0 and not got["a"]["passed"]
    # two incomplete rows and one repeated (missing) id: the score goes below zero
    assert got["b"]["quality_score"] == -50.0
    assert got["c"]["passed"] and got["c"]["quality_score"] == 100.0


def test_age_ignores_unreadable_times_and_drops_zones(spark):
    env = opened(
        spark,
        ("s", line("1", "2024-05-10T10:00:00")),
        ("s", line("2", "2024-05-10T08:00:00Z")),
        ("s", line("3", "2024-05-10T06:00:00+03:00")),
        ("s", line("4", "last week")),
        ("s", line("5", "2024")),
        ("n", line("6", "")),
    )
    got = dict(rows(ec.mean_age_hours(env, AS_OF)))
    assert got == {"s": 4.0, "n": None}
    report = {r["stream"]: r["mean_age_hours"] for r in ec.stream_report(env, AS_OF).collect()}
    assert report == got


def test_wrap_fills_missing_ids_with_empty_text(spark):
    df = spark.createDataFrame([(None, 5), ("k", None)], "id string, n int")
    wrapped = ev.wrap_envelope(df, "id", "n")
    got = rows(wrapped, ev.RAW_ID, ev.EXTRACTED_AT)
    assert got == [("", "5"), ("k", "")]
    text = [json.loads(r["value"]) for r in ev.to_lines(wrapped).collect()]
    assert text[0][ev.DATA] == {"id": None, "n": 5}  # a null is written, not left out


def test_gzip_round_trip(spark, path):
    df = spark.createDataFrame([("1", "é\"\\x")], "id string, text string")
    ev.write_jsonl_gz(ev.wrap_envelope(df, "id", "id"), path + "/out", stream="issues")
    back = ev.read_envelope(spark, path + "/out").first()
    assert back["stream"] == "issues" and back["data"]["text"] == "é\"\\x"
    assert back["missing_fields"] == []
    files = spark.read.format("binaryFile").load(path + "/out/stream=issues/*").select("path")
    assert all(".gz" in r["path"] for r in files.collect())


def test_broken_line_fails(spark):
    import pytest

    with pytest.raises(Exception, match="MALFORMED"):
        opened(spark, ("s", "not json")).collect()


def test_stream_counts_drop_empty_streams(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([("q",)], "y string")
    united = ev.union_streams({"a": a, "b": b, "none": a.limit(0)})
    assert rows(ev.stream_counts(united)) == [("a", 2), ("b", 1)]


def test_gated_promotion_end_to_end(spark, path):
    good = spark.createDataFrame([("1", "2024-05-10T10:00:00", "x")], "id string, at string, title string")
    bad = spark.createDataFrame([("1", "t", 1), ("1", "t", 2)], "id string, at string, stars int")
    result = run_gated_promotion(
        spark, {"issues": good, "stars": bad}, path, AS_OF, "id", "at", "20240510_120000"
    )
    assert rows(result.promoted, "stream", "record_count", "quality_score") == [("issues", 1, 100.0)]
    assert result.summary.first().asDict() == {
        "total_streams": 2,
        "promoted_streams": 1,
        "promotion_rate": 50.0,
        "total_records": 3,
    }
    # a field of one stream is no gap of the other
    assert {r["stream"]: r["fields_with_gaps"] for r in result.report.collect()} == {"issues": 0, "stars": 0}
    silver = spark.read.parquet(path + "/silver")
    assert rows(silver, "stream", "raw_id") == [("issues", "1")]
    assert spark.read.json(path + "/logs/dq_reports").count() == 2


def test_a_stream_is_landed_in_files_of_bounded_length(spark, path, monkeypatch):
    monkeypatch.setattr(ev, "FILE_ROWS", 2, raising=False)
    ev.write_lines_gz(spark.range(5).selectExpr("'s' AS stream", "string(id) AS value"), path + "/b", "overwrite")
    assert spark.read.text(path + "/b").count() == 5
    assert len(spark.read.text(path + "/b").inputFiles()) == 3


def test_promotion_rate_without_streams(spark):
    report = ec.quality_score(opened(spark, ("s", line()))).limit(0)
    assert ec.promotion_rate(report).first()["promotion_rate"] == 0.0


def test_gate_broadcasts_the_stored_report(spark, path):
    env = opened(spark, ("s", line()))
    ec.quality_score(env).write.parquet(path + "/report")
    joined = ec.passed_records(env, spark.read.parquet(path + "/report"))
    assert "BroadcastHashJoin" in plan(joined)


def test_rerun_of_the_checks_reads_landed_files_only(spark, path):
    df = spark.createDataFrame([("1", "2024-05-10T10:00:00")], "id string, at string")
    ev.write_jsonl_gz(ev.wrap_envelope(df, "id", "at"), path + "/bronze/r", stream="s")
    first = check_and_promote(spark, path + "/bronze/r", path + "/one", AS_OF)
    second = check_and_promote(spark, path + "/bronze/r", path + "/two", AS_OF)
    assert rows(first.report) == rows(second.report)
