import pytest

from parcelwise.functions.lineage import ensure_checkpoint_dir


@pytest.fixture(scope="session")
def spark(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    ensure_checkpoint_dir(spark)
    return spark
