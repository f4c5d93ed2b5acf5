import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from gridweave.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def small_tasks(monkeypatch):
    """Shrink the size of a task, so that small tables take the plans made for large ones."""
    from gridweave.operators import sizing

    monkeypatch.setattr(sizing, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 2)
    return sizing
