import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns named like those that operators add."""
    schema = "doc_id long, text string, fp long, id long, component string, h string, score string"

    def build(rows, parts=3):
        return spark.createDataFrame([(i, t, 1, 2, "x", "y", None) for i, t in rows], schema).repartition(parts)

    return build
