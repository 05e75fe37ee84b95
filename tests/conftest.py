import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assayframe.session import session  # noqa: E402


def make_session():
    spark = session("assayframe-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
