import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from groundshift.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def pixels(spark):
    """Builds a pixel table from {(city, yr): 2-D list}, one value column per name."""

    def build(rasters, name="urban_class", kind="int"):
        rows = [
            (city, yr, i, j, v) for (city, yr), grid in rasters.items() for i, line in enumerate(grid) for j, v in enumerate(line)
        ]
        return spark.createDataFrame(rows, f"city string, yr int, px_row int, px_col int, {name} {kind}")

    return build
