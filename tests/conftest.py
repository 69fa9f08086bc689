import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from twinsift.session import RECOMMENDED_CONF, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="twinsift-wh-", dir="/tmp")
    b = (SparkSession.builder.master("local[*]").appName("twinsift-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", warehouse)
         .config("spark.driver.memory", "8g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="twinsift-test-", dir="/tmp")
