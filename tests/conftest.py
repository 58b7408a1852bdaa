import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skein.session import session

    extra = {
        "spark.sql.shuffle.partitions": "2",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    s = session("tests", "local[4]", **extra)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(extra["spark.checkpoint.dir"])
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA
