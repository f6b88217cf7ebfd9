"""Command line: one subcommand per stage, each printing one JSON line of totals.

    python -m ledgerlake ingest    --xml-dir D (--message-dir M | --brokers B) [--topic T] [--errors-dir E] [--ledger L]
                                   [--checkpoint C]                            (only files that no run from C has read)
    python -m ledgerlake check-source (--message-dir M | --brokers B) [--topic T]  (fails when empty)
    python -m ledgerlake bronze    (--message-dir M | --brokers B) [--topic T] --bronze P
    python -m ledgerlake silver    --bronze P --silver P [--quarantine P]
    python -m ledgerlake silver-stream --message-dir M --silver P [--keep-for "24 hours"] [--snapshot P]
                                   (incremental: only new messages; copies seen within the time are dropped in flight)
    python -m ledgerlake validate  --silver P (--expected N | --ledger L)
    python -m ledgerlake gold      --silver P --gold P [--time-zone Z] [--grain date|timestamp] [--renumber]
    python -m ledgerlake questions --gold P --out P [--format csv|parquet|json]
    python -m ledgerlake run       --xml-dir D --base P [--expected N]       (all stages, offline)
    python -m ledgerlake sql       --base P --file Q.sql [--out P]            (SQL over bronze/silver/gold tables)

Exit status 1 when the quality gate fails (later stages are not run).
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from .operators.quality import QualityGateError, require_not_empty
from .plans import analytics
from .plans.ingest import ingest_documents, ingest_new_documents, read_message_dir
from .plans.layers import load_bronze, load_gold, load_silver, validate_silver
from .plans.ledger import Ledger, new_run
from .plans.star import DATE_GRAIN, TIMESTAMP_GRAIN
from .session import DEFAULT_TIME_ZONE, build_session
from .sinks.writers import read_star, register_lake, save_result
from .sources.messages import read_topic
from .streaming.incremental import run_incremental_silver_from_messages, write_snapshot


def _messages(spark, a):
    return read_topic(spark, a.brokers, a.topic) if a.brokers else read_message_dir(spark, a.message_dir)


def _questions(spark, gold: str, out: str, fmt: str) -> dict[str, int]:
    g = read_star(spark, gold)
    results = {
        "sales_by_state": analytics.sales_by_state(g["fato_vendas"], g["dim_localidade"]),
        "top_emitters": analytics.top_emitters(g["fato_vendas"], g["dim_emitente"], g["dim_localidade"]),
        "monthly_evolution": analytics.monthly_evolution(g["fato_vendas"], g["dim_data"]),
    }
    return {name: save_result(df, f"{out.rstrip('/')}/{name}", fmt) for name, df in results.items()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None)
    p.add_argument("--time-zone", default=DEFAULT_TIME_ZONE)
    sub = p.add_subparsers(dest="stage", required=True)

    def src(sp):
        sp.add_argument("--message-dir")
        sp.add_argument("--brokers")
        sp.add_argument("--topic", default="nfe-raw")

    s = sub.add_parser("ingest")
    s.add_argument("--xml-dir", required=True)
    s.add_argument("--errors-dir")
    s.add_argument("--ledger")
    s.add_argument("--checkpoint")
    src(s)
    s = sub.add_parser("check-source")
    src(s)
    s = sub.add_parser("bronze")
    s.add_argument("--bronze", required=True)
    src(s)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--quarantine")
    s = sub.add_parser("silver-stream")
    s.add_argument("--message-dir", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--keep-for")
    s.add_argument("--snapshot")
    s = sub.add_parser("validate")
    s.add_argument("--silver", required=True)
    s.add_argument("--expected", type=int)
    s.add_argument("--ledger")
    s = sub.add_parser("gold")
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--grain", choices=[DATE_GRAIN, TIMESTAMP_GRAIN], default=DATE_GRAIN)
    s.add_argument("--renumber", action="store_true")
    s = sub.add_parser("questions")
    s.add_argument("--gold", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--format", default="csv")
    s = sub.add_parser("sql")
    s.add_argument("--base", required=True)
    s.add_argument("--file", required=True)
    s.add_argument("--out")
    s = sub.add_parser("run")
    s.add_argument("--xml-dir", required=True)
    s.add_argument("--base", required=True)
    s.add_argument("--expected", type=int)
    return p


# a result is printed only as a whole; a larger one needs --out
PRINTED_ROWS = 1000


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if a.stage == "ingest" and not (a.message_dir or a.brokers):
        parser().error("ingest needs --message-dir or --brokers")
    if a.stage == "validate" and a.expected is None and not a.ledger:
        parser().error("validate needs --expected or --ledger")
    ledger = Ledger(a.ledger.rstrip("/")) if getattr(a, "ledger", None) else None
    spark = spark or build_session(a.master, time_zone=a.time_zone)
    try:
        if a.stage == "ingest":
            if a.checkpoint:
                out = ingest_new_documents(spark, a.xml_dir, a.checkpoint, a.topic, a.message_dir, a.brokers, a.errors_dir, ledger=ledger)
            else:
                out = ingest_documents(spark, a.xml_dir, a.topic, a.message_dir, a.brokers, a.errors_dir, ledger=ledger)
        elif a.stage == "check-source":
            require_not_empty(_messages(spark, a), "topic")
            out = {"not_empty": True}
        elif a.stage == "bronze":
            out = {"bronze": load_bronze(_messages(spark, a), a.bronze)}
        elif a.stage == "silver":
            out = load_silver(spark, a.bronze, a.silver, a.quarantine)
        elif a.stage == "silver-stream":
            out = run_incremental_silver_from_messages(
                spark, a.message_dir, a.silver, a.silver.rstrip("/") + "_checkpoint", keep_for=a.keep_for
            )
            if a.snapshot:
                out["snapshot"] = write_snapshot(spark, a.silver, a.snapshot)
        elif a.stage == "validate":
            out = {"checks": validate_silver(spark, a.silver, a.expected, ledger)}
        elif a.stage == "gold":
            out = load_gold(spark, a.silver, a.gold, a.time_zone, a.grain, a.renumber)
        elif a.stage == "questions":
            out = _questions(spark, a.gold, a.out, a.format)
        elif a.stage == "sql":
            register_lake(spark, a.base, f"{a.base.rstrip('/')}/_catalog")
            result = spark.sql(open(a.file, encoding="utf-8").read().strip().rstrip(";"))
            if a.out:
                out = {"rows": save_result(result, a.out)}
            else:
                rows = result.limit(PRINTED_ROWS + 1).collect()
                if len(rows) > PRINTED_ROWS:
                    print(json.dumps({"stage": a.stage, "failed": f"more than {PRINTED_ROWS} rows: name a folder with --out"}), file=sys.stderr)
                    return 2
                out = {"rows": [r.asDict() for r in rows]}
        else:  # run
            b, run = a.base.rstrip("/"), new_run()
            ledger, out, seconds = Ledger(f"{b}/ledger"), {}, {}

            def stage(name, fn):
                t0 = time.perf_counter()
                out[name] = fn()
                seconds[name] = round(time.perf_counter() - t0, 3)
                if isinstance(out[name], dict) and name != "ingest":  # which leaves its own
                    ledger.add_totals(spark, run, name, out[name])

            stage("ingest", lambda: ingest_documents(spark, a.xml_dir, "nfe-raw", f"{b}/messages", None, f"{b}/errors", ledger=ledger, run=run))
            stage("bronze", lambda: load_bronze(read_message_dir(spark, f"{b}/messages"), f"{b}/bronze"))
            ledger.add_totals(spark, run, "bronze", {"written": out["bronze"]})
            stage("silver", lambda: load_silver(spark, f"{b}/bronze", f"{b}/silver", f"{b}/quarantine"))
            stage("validate", lambda: validate_silver(spark, f"{b}/silver", a.expected, ledger))
            stage("gold", lambda: load_gold(spark, f"{b}/silver", f"{b}/gold", a.time_zone))
            stage("questions", lambda: _questions(spark, f"{b}/gold", f"{b}/results", "csv"))
            out["seconds"] = seconds
    except QualityGateError as e:
        print(json.dumps({"stage": a.stage, "failed": e.failures}, default=str), file=sys.stderr)
        return 1
    print(json.dumps({"stage": a.stage, **out}, default=str))
    return 0
