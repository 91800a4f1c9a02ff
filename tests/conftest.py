import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from zonecast.session import build_session

    folder = tempfile.mkdtemp(prefix="zonecast-tests-")
    session = build_session(
        "tests", "local[8]", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.maxMetadataStringLength": "5000"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
