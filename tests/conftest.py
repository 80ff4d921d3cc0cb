import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).parents[1]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def timeline_of(spark):
    """Frames from lists of labels by video: label, and pred and valid if given."""

    def make(labels, pred=None, valid=None):
        rows = []
        for v, own in labels.items():
            for i, x in enumerate(own):
                rows.append((v, i, x, (pred or labels)[v][i], (valid or {v: [1] * len(own)})[v][i]))
        return spark.createDataFrame(rows, "video_id string, frame int, label int, pred int, valid int")

    return make
