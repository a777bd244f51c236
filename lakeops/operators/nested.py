"""Completeness of nested records, path by path, with VARIANT values.

``read_envelope`` holds a record as a map of text, which flattens what is nested. Here the
record is one VARIANT: numbers, texts and objects keep their kinds, and every path such as
``user.login`` is counted by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeops.sources.envelopes import DATA, EXTRACTED_AT, RAW_ID, REQUIRED_FIELDS


def open_nested(lines: DataFrame) -> DataFrame:
    """Envelopes from a ``value`` column of JSON text, the record as VARIANT ``data``.

    Other columns are kept. A line that is not JSON fails the job; null has no fields.
    """
    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*rest, F.parse_json("value").alias("_v"))
    field = lambda name: f"$['{name}']"
    missing = F.array_compact(F.array(*[F.when(F.variant_get("_v", field(f), "variant").isNull(), F.lit(f)) for f in REQUIRED_FIELDS]))
    return parsed.select(
        *rest,
        F.variant_get("_v", field(RAW_ID), "string").alias("raw_id"),
        F.variant_get("_v", field(EXTRACTED_AT), "string").alias("extracted_at"),
        F.variant_get("_v", field(DATA), "variant").alias("data"),
        missing.alias("missing_fields"),
    )


def paths_of(records: DataFrame, data: str = "data") -> list[tuple[str, ...]]:
    """Every path of keys that some record has, parents before children.

    One aggregation merges the schemas of all records; its result, one text as long as the
    list of paths, is all that reaches the driver. Where a value is an object in some records
    and something else in others, the schemas do not merge: one more aggregation, over all such
    paths, looks below their objects, and so on down. Arrays count as values.
    """
    found: list[tuple[str, ...]] = []
    pending: list[tuple[str, ...]] = [()]
    while pending:
        objects = [F.when(_is_object(_at(data, p)), _at(data, p)) for p in pending]
        merged = records.agg(*[F.schema_of_variant_agg(o).alias(str(i)) for i, o in enumerate(objects)]).first()
        mixed = []
        for above, text in zip(pending, merged):
            if text and text.startswith("OBJECT<"):
                for path, kind in _walk(T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")), above):
                    found.append(path)
                    if isinstance(kind, T.VariantType):
                        mixed.append(path)
        pending = mixed
    return found


def _walk(kind: T.DataType, above: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield (*above, field.name), field.dataType
            yield from _walk(field.dataType, (*above, field.name))


def _json_path(path: tuple[str, ...]) -> str:
    return "$" + "".join("['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']" for p in path)


def _at(data: str, path: tuple[str, ...]) -> Column:
    return F.col(data) if not path else F.try_variant_get(data, _json_path(path), "variant")


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def completeness_by_path(
    records: DataFrame, by: tuple[str, ...] = ("stream",), data: str = "data", paths: list[tuple[str, ...]] | None = None
) -> DataFrame:
    """``by``, path, parents, absent, nulls, empty, filled for every path.

    parents counts the records whose parent is an object; of those the key is absent, null,
    an empty text, or filled. All paths are counted in one aggregation over the records,
    with partial sums before the shuffle.
    """
    paths = paths_of(records, data) if paths is None else paths
    if not paths:
        return records.select(
            *by, F.lit("").alias("path"), *[F.lit(0).cast("bigint").alias(c) for c in ("parents", "absent", "nulls", "empty", "filled")]
        ).where("false")
    counts = []
    for path in paths:
        value, parent = _at(data, path), _is_object(_at(data, path[:-1]))
        empty = F.try_variant_get(data, _json_path(path), "string") == ""
        there = parent & value.isNotNull()
        null, blank = there & F.is_variant_null(value), there & F.coalesce(empty, F.lit(False))
        counts.append(
            F.struct(
                F.lit(".".join(path)).alias("path"),
                F.count_if(parent).alias("parents"),
                F.count_if(parent & value.isNull()).alias("absent"),
                F.count_if(null).alias("nulls"),
                F.count_if(blank).alias("empty"),
                F.count_if(there & ~null & ~blank).alias("filled"),
            )
        )
    return records.groupBy(*by).agg(F.array(*counts).alias("_paths")).select(*by, F.inline("_paths"))
