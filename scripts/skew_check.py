"""Skew check: run the keyed operators on a table where one key holds a third of all rows.

Writes Spark's event log to a fresh scratch folder and reports, per operator, the
largest number of shuffle records one task read. With map-side reduction the hot
key costs at most one row per map task; without it one task would read a third
of the table.

    python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    from pyspark.sql import functions as F

    from nimbus.operators import audit, rollup, series, staging
    from nimbus.session import build_session
    from nimbus.sources import testdata as td
    spark = build_session("local[8]", app="skew-check", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    base = td.readings(spark, sf_dir)
    n = base.count()
    one = base.filter(F.col("id") == 1)
    # n/2 copies of one reading under new ids: the hot key then holds a third of all rows
    hot = (one.select(F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_k"), *one.columns)
           .withColumn("id", F.col("id") + F.col("_k").cast("long") * 100_000_000).drop("_k"))
    skewed = base.unionByName(hot).repartition(16).persist()
    total = skewed.count()
    ops = {
        "dedupe": staging.dedupe(skewed),
        "latest_per_city": series.latest_per_city(skewed),
        "hourly_avg": rollup.hourly_avg(skewed),
        "pk_audit": audit.pk_violations(skewed, ["city_id", "timestamp"]),
        "detect_changes": series.detect_changes(skewed),
    }
    marks = {}
    for name, df in ops.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        marks[name] = True
    spark.stop()

    stage_group, worst = {}, {}
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    g = stage_group.get(ev.get("Stage ID"))
                    if g in marks:
                        worst[g] = max(worst.get(g, 0), recs)
    print(json.dumps({"rows": total, "hot_key_rows": n // 2,
                      "max_shuffle_records_read_by_one_task": worst, "event_log": log_dir}))


if __name__ == "__main__":
    main()
