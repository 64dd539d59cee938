import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import build_session, checkpoint_root

    s = build_session(
        "local[4]",
        app_name="marketlake-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from marketlake.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
