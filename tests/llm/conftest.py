import pytest

from compare import DATA
from lakeops.llm.frames import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def sf():
    return str(DATA / "sf0.001")


@pytest.fixture
def docs(llm):
    """Documents from (id, text) or (id, text, source); more columns have names that operators use."""

    def make(*rows):
        from pyspark.sql import functions as F

        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = llm.createDataFrame(full, DOCS)
        return df.withColumns({c: F.lit(7) for c in ("row", "id", "t", "words", "h", "size", "key", "host", "kept", "component", "n")})

    return make
