import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema): a small table with a clashing extra column."""
    def make(rows, schema, extra=True):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", *[f"'x' as {c}" for c in ("size", "score", "key", "n", "v", "host", "rank") if extra])
    return make
