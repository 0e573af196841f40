import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from termspark.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="termspark-test-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()
