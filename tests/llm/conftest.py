import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Rows to a table of documents; with clashing extra columns and more partitions than rows, on demand."""

    def table(rows, schema="doc_id bigint, text string", extra=False):
        df = spark.createDataFrame(rows, schema)
        if extra:
            names = ("node", "label", "digest", "key", "row", "number", "position", "bucket", "part", "ids", "component", "html_", "_id", "target")
            df = df.selectExpr("*", *(f"'x' AS {n}" for n in names))
        return df.repartition(3)

    return table
