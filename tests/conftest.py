import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakeaudit.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", "lakeaudit-tests",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from lakeaudit.sources.tables import Lake

    return Lake(spark, SF_DIR)
