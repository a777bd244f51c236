"""The library's expressions as SQL functions, for those who write SQL over the registered tables.

They are SQL-defined: the planner puts their bodies in place, so no worker and no call
is left in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

_ISO = r"^(\\d{4})-?(\\d{2})-?(\\d{2})[T ](\\d{2}):?(\\d{2}):?(\\d{2})([.,]\\d{1,6})?\\d*(Z|[+-]\\d{2}(:?\\d{2})?)?$"


def register_functions(
    spark: SparkSession, tiers: Sequence[tuple[float, str]] = ((1000, "High Value"), (500, "Medium Value")), default: str = "Low Value"
) -> list[str]:
    """Create or replace the temporary functions; their names.

    ``half_up(value, digits)``; ``money(amount)`` (an exact amount, to be summed);
    ``pct(part, whole)``; ``value_tier(spend)``; ``iso_time(text)``, null for what is not a
    moment with a time of day; ``fill_in(template, name, value)``, which fills one
    ``{{name}}``.
    """
    cases = " ".join(f"WHEN spend > {limit} THEN '{name}'" for limit, name in tiers)
    bodies = {
        "half_up(value DOUBLE, digits INT) RETURNS DOUBLE": "floor(value * power(10D, digits) + 0.5D) / power(10D, digits)",
        "money(amount DOUBLE) RETURNS DECIMAL(18, 4)": "CAST(amount AS DECIMAL(18, 4))",
        "pct(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": "floor(100D * part / nullif(whole, 0D) * 100D + 0.5D) / 100D",
        "value_tier(spend DOUBLE) RETURNS STRING": f"CASE {cases} ELSE '{default}' END",
        "iso_time(txt STRING) RETURNS TIMESTAMP_NTZ": f"""CASE WHEN txt RLIKE '{_ISO}' THEN try_cast(regexp_replace(
            regexp_replace(txt, '{_ISO}', '$1-$2-$3 $4:$5:$6$7'), ',', '.') AS TIMESTAMP_NTZ) END""",
        "fill_in(template STRING, name STRING, value STRING) RETURNS STRING": """array_join(transform(
            split(template, concat('\\\\{\\\\{\\\\s*', name, '\\\\s*\\\\}\\\\}'), -1), piece -> piece), coalesce(value, ''))""",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in bodies]
