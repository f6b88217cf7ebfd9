"""Hot-key check of the clean layer: re-key every invoice of one status class (about a
third of all messages) to a single invoice id, run the clean layer, and report per-task
rows and times of its stages from the event log.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.plans.bronze import bronze_rows  # noqa: E402
from ledgerlake.plans.silver import clean  # noqa: E402
from ledgerlake.session import build_session, scratch_path  # noqa: E402
from ledgerlake.sinks.writers import write_bronze  # noqa: E402
from ledgerlake.sources.layers import read_bronze  # noqa: E402
from ledgerlake.sources.tables import invoice_messages  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="ledgerlake-events-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    msgs = invoice_messages(spark, sf_dir)
    text = F.col("value").cast("string")
    hot = F.encode(F.regexp_replace(text, '"id_nfe":"[^"]*"', '"id_nfe":"HOT"'), "UTF-8")
    msgs = msgs.withColumn("value", F.when(F.get_json_object(text, "$.serie") == "P", hot).otherwise(F.col("value")))
    path = scratch_path(spark, "skew_bronze")
    write_bronze(bronze_rows(msgs), path)
    share = read_bronze(spark, path).agg(F.avg((F.get_json_object("payload", "$.id_nfe") == "HOT").cast("int"))).first()[0]
    spark.sparkContext.setJobDescription("skewed_clean")
    t0 = time.perf_counter()
    clean(read_bronze(spark, path)).silver.write.format("noop").mode("overwrite").save()
    seconds = round(time.perf_counter() - t0, 2)
    spark.stop()

    stage_job, tasks = {}, {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        raw = open(f, "rb").read()
        text_log = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text_log.splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    stage_job[s] = (e.get("Properties") or {}).get("spark.job.description")
            elif e.get("Event") == "SparkListenerTaskEnd" and stage_job.get(e["Stage ID"]) == "skewed_clean":
                m = e.get("Task Metrics") or {}
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(
                    (ti["Finish Time"] - ti["Launch Time"], (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
                )
    print(json.dumps({"hot_share": round(share, 3), "clean_seconds": seconds}))
    for s, ts in sorted(tasks.items()):
        ms = sorted(t[0] for t in ts)
        rows = sorted(t[1] for t in ts)
        print(json.dumps({"stage": s, "tasks": len(ts), "shuffle_rows_max": rows[-1], "shuffle_rows_median": rows[len(rows) // 2],
                          "ms_max": ms[-1], "ms_median": ms[len(ms) // 2]}))


if __name__ == "__main__":
    main()
