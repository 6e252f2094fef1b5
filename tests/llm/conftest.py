import pytest

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture()
def docs(spark):
    """Builds a documents-like table with extra columns whose names clash with inner ones."""

    def make(rows, schema="doc_id long, text string, source string"):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "'x' AS id", "1 AS n", "'y' AS rep", "2 AS size", "'z' AS host", "3 AS digest", "'w' AS value", "'v' AS item")

    return make
