import pytest
from pyspark.sql import functions as F

from lakeops.functions.text import preview, render
from lakeops.operators import prompts as pr
from lakeops.schemas import PROMPTS
from tests.helpers import at, rows


@pytest.mark.parametrize(
    "template, variables, want",
    [
        ("Analise: {{dados}}", {"dados": "x"}, "Analise: x"),
        ("{{ dados }}{{dados}}", {"dados": "x"}, "xx"),
        ("a {{outro}} b", {"dados": "x"}, "a {{outro}} b"),
        ("a {{ outro }} b", {"dados": "x"}, "a {{ outro }} b"),
        ("{{a}} {{b}}", {"a": "{{b}}", "b": "y"}, "{{b}} y"),  # values are not expanded
        ("{{a}}", {"a": None}, ""),
        ("no variables", {"a": "x"}, "no variables"),
        ("{{a", {"a": "x"}, "{{a"),
        ("{{{a}}}", {"a": "x"}, "{{{a}}}"),
        ("$1 \\ {{a}}", {"a": "$0 \\1"}, "$1 \\ $0 \\1"),
        ("", {"a": "x"}, ""),
        ("x\n{{\na\n}}", {"a": "1"}, "x\n1"),
    ],
)
def test_render(spark, template, variables, want):
    df = spark.createDataFrame([(template, variables)], "t string, v map<string,string>")
    assert df.select(render(F.col("t"), F.col("v"))).first()[0] == want


def test_preview(spark):
    df = spark.createDataFrame([("abcdef",), ("abc",)], "t string")
    assert [r[0] for r in df.select(preview(F.col("t"), 3)).collect()] == ["abc...", "abc"]


def registry(spark):
    def row(name, text, config, tags, when, labels=None):
        return (name, "text", text, config, labels or tags[:1], tags, at(when))

    data = [
        row("support", "polite: {{pergunta}}", ("m", 0.7, 300), ["v1", "first"], "2024-01-01"),
        row("support", "better: {{pergunta}}", ("m", None, 400), ["v2", "better"], "2024-01-02"),
        row("support", "short: {{pergunta}}", ("m", 0.0, None), ["v3"], "2024-01-03"),
        row("summary", "sum {{texto}}", ("m", 0.5, 300), ["production"], "2024-01-01"),
    ]
    return pr.version_prompts(spark.createDataFrame(data, PROMPTS))


def test_versions_count_up_per_name(spark):
    got = rows(registry(spark), "name", "version", "labels")
    assert got == [
        ("summary", 1, ["production"]),
        ("support", 1, ["v1"]),
        ("support", 2, ["v2"]),
        ("support", 3, ["v3"]),
    ]


def test_by_label_latest_and_defaults(spark):
    reg = registry(spark)
    v2 = pr.prompt_by_label(reg, "v2", "support").first()
    assert (v2["version"], v2["temperature"], v2["max_tokens"]) == (2, 0.7, 400)
    newest = pr.prompt_by_label(reg, name="support").first()
    assert (newest["version"], newest["temperature"], newest["max_tokens"]) == (3, 0.0, 300)
    assert rows(pr.prompt_by_label(reg), "name", "version") == [("summary", 1), ("support", 3)]
    assert pr.prompt_by_label(reg, "nobody").count() == 0


def test_first_tag_becomes_label(spark):
    df = spark.createDataFrame([(["v9", "x"],), ([],)], "tags array<string>")
    assert [r["labels"] for r in pr.new_version(df).collect()] == [["v9"], []]


def test_render_and_compare(spark):
    reg = registry(spark)
    inputs = spark.createDataFrame([("support", 1, "why?"), ("nobody", 2, "x")], "name string, i int, q string")
    variables = {"pergunta": F.col("q")}
    out = pr.render(pr.prompt_by_label(reg), inputs, variables)
    assert rows(out, "i", "rendered") == [(1, "short: why?")]
    both = pr.compare(reg, inputs, variables, "v1", "v2", preview_chars=6).first()
    assert (both["text_a"], both["text_b"]) == ("polite: why?", "better: why?")
    assert (both["length_a"], both["preview_a"]) == (12, "polite...")


def test_listing(spark):
    got = pr.listing(registry(spark)).where("name = 'support' AND version = 1").first()
    assert (got["labels"], got["tags"], got["length"]) == ("v1", "v1, first", 20)
