import pytest


@pytest.fixture(scope="session", autouse=True)
def scratch(spark, tmp_path_factory):
    """A shared folder for what the operators write in between."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
