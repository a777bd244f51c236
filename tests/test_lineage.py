import pytest

from lakeops.operators import lineage as ln
from tests.helpers import rows

JOBS = [
    ("ingest", [], ["raw"]),
    ("clean", ["raw"], ["silver"]),
    ("check", ["silver"], []),
    ("aggregate", ["silver", "dims"], ["daily", "products"]),
    ("report", ["daily"], ["dashboard"]),
]


def edges(spark, jobs=JOBS):
    return ln.lineage_edges(ln.declare(spark, jobs))


def test_edges_cover_tasks_that_only_read_or_only_write(spark):
    got = rows(edges(spark, JOBS[:3] + JOBS[:1]))
    assert got == sorted(
        [
            (None, "ingest", "raw"),
            ("raw", "clean", None),
            (None, "clean", "silver"),
            ("silver", "check", None),
        ],
        key=repr,
    )


def test_impact_and_root_cause(spark):
    e = edges(spark)
    assert rows(ln.lineage_impact(e, "raw")) == [
        ("daily", 2),
        ("dashboard", 3),
        ("products", 2),
        ("silver", 1),
    ]
    assert rows(ln.lineage_impact(e, "dashboard", "upstream")) == [
        ("daily", 1),
        ("dims", 2),
        ("raw", 3),
        ("silver", 2),
    ]
    assert rows(ln.lineage_impact(e, "raw", max_depth=1)) == [("silver", 1)]
    assert rows(ln.lineage_impact(e, "unknown")) == []


def test_cycles_end_and_the_shortest_way_counts(spark):
    e = edges(spark, [("f", ["a"], ["b"]), ("g", ["b"], ["c"]), ("h", ["c"], ["a"]), ("k", ["a"], ["c"])])
    assert rows(ln.lineage_impact(e, "a")) == [("b", 1), ("c", 1)]


def test_direction_is_checked(spark):
    with pytest.raises(ValueError, match="direction"):
        ln.lineage_impact(edges(spark), "raw", "sideways")
