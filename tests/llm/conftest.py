import pytest

from tests.llm.edges import frame


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """The awkward rows as a stored table in several files."""
    path = str(tmp_path_factory.mktemp("awkward") / "documents")
    frame(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
