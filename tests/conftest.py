import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsflow.session import build_session, new_folder  # noqa: E402
from newsflow.sources.warehouse import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture
def warehouse(spark, folder):
    return Warehouse(spark, folder.rsplit("/", 1)[1].replace("-", "_"), folder)
