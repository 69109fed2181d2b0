"""Stage-level profile of one named query from Spark's event log (no UI).

    python tests/stage_profile.py m1_most_similar [sf_dir]

Runs the query into the no-op sink in a session that writes its event log to
a fresh scratch folder, then prints the query's jobs/stages: wall time, task
count, summed and maximum task run time. Fixture tables are loaded (and a
warm-up query run) before the profiled query.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    for f in sorted(glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd")):
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode() \
            if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            yield json.loads(line)


def main(argv: list[str]) -> None:
    name = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="ms-eventlog-")
    from marketscope.plans.queries import QUERIES
    from marketscope.session import get_session
    from marketscope.sources import fixtures
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    fixtures.registry(spark, sf_dir)
    fixtures.inputs(spark, sf_dir)
    QUERIES["j4_client_codes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("profiled", name)
    t0 = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()

    stage_group, stages, tasks = {}, {}, {}
    for e in _events(log_dir):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:50], si["Number of Tasks"],
                                      (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                                      si.get("Submission Time", 0))
        elif ev == "SparkListenerTaskEnd":
            run = (e.get("Task Metrics") or {}).get("Executor Run Time", 0) / 1000
            t = tasks.setdefault(e["Stage ID"], [0.0, 0.0])
            t[0] += run
            t[1] = max(t[1], run)
    mine = {k: v for k, v in stages.items() if stage_group.get(k) == "profiled"}
    if not mine:
        print("no stages recorded")
        return
    start = min(v[3] for v in mine.values())
    print(f"{name}: wall {wall:.2f} s, {len(mine)} stages, task time {sum(tasks.get(k, [0])[0] for k in mine):.1f} s")
    for sid, (stage, n, dur, sub) in sorted(mine.items(), key=lambda kv: kv[1][3]):
        t = tasks.get(sid, [0.0, 0.0])
        print(f"  stage {sid:4d} +{(sub - start) / 1000:6.2f}s wall {dur:6.2f} tasks {n:4d} "
              f"sum {t[0]:6.2f} max {t[1]:5.2f}  {stage}")


if __name__ == "__main__":
    main(sys.argv)
