import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starfold.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame({'col': [values]}) or frame(rows, schema)."""
    import pandas as pd

    def make(data, schema=None):
        if isinstance(data, dict):
            return spark.createDataFrame(pd.DataFrame(data), schema)
        return spark.createDataFrame(data, schema)

    return make
