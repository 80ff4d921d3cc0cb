"""Results do not depend on how rows are partitioned or in which order they come."""

import os

import pytest
from pyspark.sql import functions as F

from tempoloom.operators import audit, catalog, evaluate, postprocess, resample, timeline, windows
from tempoloom.plans.adapters import document_catalog, event_frames

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")

OPERATORS = {
    "runs": lambda f: timeline.segments(f),
    "gaps filled": lambda f: timeline.forward_fill(f, {"value": F.lit(0.0)}),
    "intervals": lambda f: timeline.frames_to_intervals(f, 15.0),
    "labels by mode": lambda f: resample.mode_labels(f, 29.97, 15.0),
    "windows": lambda f: windows.labelled_windows(f, 8, 3, keep_background=0.5),
    "action windows": lambda f: windows.action_windows(f, 8, 3, 4),
    "duration": lambda f: postprocess.filter_duration(f, 3),
    "matches": lambda f: evaluate.match_counts(f, [0.1, 0.5]),
    "confusion": lambda f: evaluate.confusion(f),
    "rates": lambda f: audit.class_rates(f),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_partitions_do_not_matter(spark, name):
    base = event_frames(spark, DATA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n, frames in (("1", base), ("7", base.repartition(5, "value")), ("3", base.orderBy(F.desc("frame")))):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(map(str, OPERATORS[name](frames).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] and seen[0] == seen[1] == seen[2]


def test_splits_of_subjects_do_not_overlap(spark):
    d = document_catalog(spark, DATA)
    splits = catalog.hashed_splits(d, "subject_id", (0.7, 0.15, 0.15))
    records = catalog.manifest_records(d.withColumn("quality_passed", F.lit(True)), splits, d.where("dirty"))
    assert records.groupBy("subject_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert catalog.leaks(records).count() == 0 and records.join(d.where("dirty"), "video_id", "left_semi").count() == 0
