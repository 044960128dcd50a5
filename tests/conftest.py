import os

import pytest

from tidemark.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("OFF")
    # Cut even small inputs into many buckets, so that every scan crosses borders.
    session.conf.set("tidemark.rowsPerBucket", "60")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
