"""The streams of the workload on an events table of several splits."""

import os
from pathlib import Path

import pyarrow.parquet as pq

from quayside import workload
from quayside.session import shared_dir

workload.load_all()

SF = "/root/testdata/sf0.001"


def test_feed_is_written_by_all_tasks_and_mapped_in_three(spark, tmp_path):
    for name in os.listdir(SF):
        if name != "events.parquet":
            os.symlink(f"{SF}/{name}", tmp_path / name)
    events = pq.read_table(f"{SF}/events.parquet")
    pq.write_table(events, tmp_path / "events.parquet", row_group_size=len(events) // 6 + 1)
    small = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    root = Path(shared_dir(spark).removeprefix("file://"))
    before = set(root.glob("map-*"))
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = sorted(map(tuple, workload.QUERIES["stream_land_and_map"](spark, str(tmp_path)).collect()), key=str)
    finally:
        for k in small:
            spark.conf.unset(k)
    (run,) = set(root.glob("map-*")) - before
    assert len(list(run.glob("in/*.parquet"))) > 3
    assert len(list(run.glob("lake/bronze/Registry/_commit_version=*/_SUCCESS"))) <= 3
    assert len([f for f in run.glob("map/commits/*") if f.name.isdigit()]) <= 3
    assert got == sorted(map(tuple, workload.QUERIES["stream_land_and_map"](spark, SF).collect()), key=str)
