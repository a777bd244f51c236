"""Template rendering and previews as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: ``{{ name }}``, from the first ``{{`` to the next ``}}``.
PLACEHOLDER = r"(?s)\{\{(.*?)\}\}"


def render(template: Column, variables: Column) -> Column:
    """Fill ``{{name}}`` placeholders from a map in one pass over the template.

    Blanks around the name are ignored, a null value renders as nothing, an unknown
    name stays as written, and text that a value brings in is never expanded again.
    """
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1))
    around = F.split(template, PLACEHOLDER, -1)

    def piece(text: Column, i: Column) -> Column:
        raw = F.get(names, i)
        name = F.regexp_replace(raw, r"^\s+|\s+$", "")
        value = F.when(
            F.map_contains_key(variables, name),
            F.coalesce(F.try_element_at(variables, name), F.lit("")),
        ).otherwise(F.concat(F.lit("{{"), raw, F.lit("}}")))
        return F.when(raw.isNull(), text).otherwise(F.concat(text, value))

    return F.array_join(F.transform(around, piece), "")


def preview(text: Column, n: int) -> Column:
    """The first ``n`` characters and an ellipsis when there are more."""
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)
