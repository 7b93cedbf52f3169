"""Shuffle bytes of the enrolment ⋈ calendar overlap join, broadcast vs
sort-merge, read from Spark's event log in a fresh scratch folder.

  python tools/shuffle_bytes.py /root/testdata/sf0.1
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("shuffle-bytes")
             .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from rollbook.plans.common import yearrec_calendars
    from rollbook.plans.enrollment import enrolment_sources
    from rollbook.operators.relational import school_key_map
    from rollbook.sources.catalog import Tables
    t = Tables.from_driver(spark, sf)
    src = enrolment_sources(t)
    skm = school_key_map(t.schools)
    m = src.join(F.broadcast(skm), src["school_key"] == skm["school_key"]).drop(skm["school_key"]) \
        .withColumn("schoolNum_str", F.col("schoolNum").cast("string"))
    cal = yearrec_calendars(t)
    cond = ((m["schoolNum_str"] == cal["schoolNum_raw"]) & (m["startDate_raw"] <= cal["endDate_dt"])
            & (F.coalesce(m["endDate_raw"], cal["endDate_dt"]) >= cal["startDate_dt"]))
    results = {}
    for label, right, threshold in (("broadcast", F.broadcast(cal), "10485760"), ("sort_merge", cal, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.time()
        m.join(right, cond).write.format("noop").mode("overwrite").save()
        results[label] = {"seconds": round(time.time() - t0, 2)}
    spark.stop()
    # sum shuffle write bytes per job group from the event log
    stage_group, written = {}, {}
    import os
    for path in sorted(glob.glob(f"{logdir}/**/*", recursive=True)):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        for line in open(path, encoding="utf-8"):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = grp
            elif kind == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                g = stage_group.get(ev.get("Stage ID"))
                written[g] = written.get(g, 0) + m.get("Shuffle Bytes Written", 0)
    for label in results:
        results[label]["shuffle_bytes_written"] = written.get(label, 0)
    print(json.dumps({"sf": sf, "overlap_join": results}))


if __name__ == "__main__":
    main()
