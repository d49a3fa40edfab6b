import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linecheck.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4",
        "linecheck-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.sql.legacy.javaCharsets": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
