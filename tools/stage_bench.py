"""Per-stage times of the whole flow on one-document-per-file input (the layout of
scheduled document drops): documents are written from the given tables, then
``python -m ledgerlake run`` is executed in-process and its stage times printed.

Usage: python tools/stage_bench.py <sf_dir> [cpus]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.cli import main  # noqa: E402
from ledgerlake.session import build_session, scratch_path  # noqa: E402
from ledgerlake.sinks.xml import invoice_document  # noqa: E402
from ledgerlake.sources.tables import invoice_records  # noqa: E402


def write_one_file_per_document(spark, sf_dir: str, out: str) -> int:
    """Each order's document as its own file ``nfe_<key>.xml`` (written with the text
    writer partitioned by document, so the file system gets one file per document)."""
    docs = invoice_records(spark, sf_dir).select(invoice_document().alias("value"), "arquivo_origem")
    staging = out + "_staging"
    docs.write.mode("overwrite").partitionBy("arquivo_origem").text(staging)
    n = 0
    os.makedirs(out, exist_ok=True)
    for d in os.listdir(staging):
        if d.startswith("arquivo_origem="):
            name = d.split("=", 1)[1]
            part = [f for f in os.listdir(os.path.join(staging, d)) if f.startswith("part-")][0]
            os.link(os.path.join(staging, d, part), os.path.join(out, name))
            n += 1
    return n


def main_() -> None:
    sf_dir = sys.argv[1]
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = build_session(f"local[{cpus}]", app_name="ledgerlake-stages", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "stage_bench")  # a local shared folder: the document files are linked on disk
    xml_dir = base + "_xml"
    t0 = time.perf_counter()
    n = write_one_file_per_document(spark, sf_dir, xml_dir)
    print(json.dumps({"documents": n, "write_seconds": round(time.perf_counter() - t0, 2)}))
    main(["run", "--xml-dir", xml_dir, "--base", base], spark=spark)


if __name__ == "__main__":
    main_()
