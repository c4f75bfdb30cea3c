import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pyspark.sql import SparkSession  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("ticketflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sc = session.sparkContext
    if not sc.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ticketflow-test-ckpt-"))
    from ticketflow.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(session)
    yield session
    session.stop()
