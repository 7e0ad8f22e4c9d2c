import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path(os.environ.get("RECORDLENS_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def spark(shared_folder):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("recordlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{shared_folder}/")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def medium():
    return str(DATA / "sf0.01")
