import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from mandrel.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session(
        "local[4]", "tests",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"{shared}/warehouse", "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
