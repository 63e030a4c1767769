import pytest
from samples import DOC_DDL, ODD


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeats, null ids and sources, clashing columns."""
    return spark.createDataFrame(ODD, DOC_DDL).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_DDL)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def plain(odd):
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
