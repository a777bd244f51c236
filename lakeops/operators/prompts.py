"""Versioned prompt registry: versions, labels, rendering, comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.text import preview, render as render_text
from lakeops.operators.ordered import number_rows

LATEST = "latest"

# What a prompt without its own setting runs with
DEFAULT_TEMPERATURE = 0.7
DEFAULT_MAX_TOKENS = 300


def new_version(df: DataFrame) -> DataFrame:
    """Rows for a new version of existing prompts: the first tag becomes the label."""
    return df.withColumn("labels", F.slice("tags", 1, 1))


def version_prompts(df: DataFrame, tie: str = "prompt") -> DataFrame:
    """Number the prompts of a name by creation time, from 1."""
    return number_rows(df, ["name"], ["created_at", tie], "version")


def prompt_by_label(
    versioned: DataFrame, label: str = LATEST, name: str | None = None
) -> DataFrame:
    """The newest version per name that carries a label, or the newest of all.

    Settings a version leaves open are filled with the defaults.
    """
    wanted = versioned if name is None else versioned.where(F.col("name") == name)
    if label != LATEST:
        wanted = wanted.where(F.array_contains("labels", label))
    rest = [c for c in versioned.columns if c != "name"]
    newest = wanted.groupBy("name").agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    out = newest.select("name", *[F.col(f"_row.{c}").alias(c) for c in rest])
    return with_config_defaults(out) if "config" in rest else out


def _newest_prompt(label: str) -> Column:
    """Aggregate: the text of the newest version that carries the label."""
    carries = F.lit(True) if label == LATEST else F.array_contains("labels", label)
    return F.max_by("prompt", F.when(carries, F.col("version")))


def with_config_defaults(
    df: DataFrame,
    temperature: float = DEFAULT_TEMPERATURE,
    max_tokens: int = DEFAULT_MAX_TOKENS,
) -> DataFrame:
    return df.withColumns(
        {
            "temperature": F.coalesce("config.temperature", F.lit(temperature)),
            "max_tokens": F.coalesce("config.max_tokens", F.lit(max_tokens).cast("bigint")),
        }
    )


def variables_of(variables: Mapping[str, Column]) -> Column:
    pairs: list[Column] = []
    for name, value in variables.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def render(prompts: DataFrame, inputs: DataFrame, variables: Mapping[str, Column]) -> DataFrame:
    """Every input rendered with the prompt it names (column ``name`` on both sides).

    ``prompts`` has one row per name, as ``prompt_by_label`` returns; ``variables`` are
    expressions over the input's columns.
    """
    return inputs.join(prompts.select("name", "prompt"), "name").withColumn(
        "rendered", render_text(F.col("prompt"), variables_of(variables))
    )


def compare(
    versioned: DataFrame,
    inputs: DataFrame,
    variables: Mapping[str, Column],
    label_a: str,
    label_b: str,
    preview_chars: int = 200,
) -> DataFrame:
    """Two labelled versions rendered side by side over the same inputs.

    Inputs meet the pair of versions of the prompt they name: one joined row per input,
    however many inputs or prompts there are.
    """
    pairs = versioned.groupBy("name").agg(
        _newest_prompt(label_a).alias("_a"), _newest_prompt(label_b).alias("_b")
    )
    both = pairs.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    filled = variables_of(variables)
    sides = inputs.join(both, "name").withColumns(
        {"text_a": render_text(F.col("_a"), filled), "text_b": render_text(F.col("_b"), filled)}
    )
    return sides.select(
        *inputs.columns,
        "text_a",
        "text_b",
        F.length("text_a").alias("length_a"),
        F.length("text_b").alias("length_b"),
        preview(F.col("text_a"), preview_chars).alias("preview_a"),
        preview(F.col("text_b"), preview_chars).alias("preview_b"),
    )


def listing(versioned: DataFrame, preview_chars: int = 80) -> DataFrame:
    """Prompts with labels and tags joined for display."""
    return versioned.select(
        "name",
        "version",
        F.array_join("labels", ", ").alias("labels"),
        F.array_join("tags", ", ").alias("tags"),
        preview(F.col("prompt"), preview_chars).alias("preview"),
        F.length("prompt").alias("length"),
    )
