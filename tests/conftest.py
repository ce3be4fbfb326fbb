import pytest

from tests.session import spark_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = spark_session()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark
