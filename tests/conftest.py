import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from parcelyard import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session.build(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stages")),
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
