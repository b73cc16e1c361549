"""Job entry point for spark-submit:

    spark-submit -m obslake load  --lake s3a://bucket/data/weather --target s3a://bucket/flat
    spark-submit -m obslake train --flat ... --models ... --day 2025-09-09
    spark-submit -m obslake score --lake ... --models ... --batch 2025-09-09_1500 --reports ...
    spark-submit -m obslake stream-load --lake ... --target ... --checkpoint ... [--every "3 minutes"] [--max-files N]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from obslake.plans import jobs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="obslake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--lake", required=True)
    ld.add_argument("--target", required=True)
    ld.add_argument("--quarantine")
    ld.add_argument("--batch", action="append")
    tr = sub.add_parser("train")
    tr.add_argument("--flat", required=True)
    tr.add_argument("--models", required=True)
    tr.add_argument("--day", default=dt.date.today().isoformat())
    tr.add_argument("--train-pct", type=int)
    sc = sub.add_parser("score")
    sc.add_argument("--lake", required=True)
    sc.add_argument("--models", required=True)
    sc.add_argument("--batch", action="append", required=True)
    sc.add_argument("--reports", required=True)
    st = sub.add_parser("stream-load")
    st.add_argument("--lake", required=True)
    st.add_argument("--target", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--every", help="processing-time trigger, e.g. '3 minutes'; default availableNow")
    st.add_argument("--max-files", type=int, help="files per micro-batch (bounded backfills)")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"obslake-{a.cmd}").getOrCreate()
    if a.cmd == "load":
        r = jobs.load_job(spark, a.lake, a.target, a.quarantine, a.batch)
        print(f"inserted {r.inserted}")
    elif a.cmd == "train":
        print(jobs.train_job(spark, a.flat, a.models, a.day, train_pct=a.train_pct))
    elif a.cmd == "score":
        jobs.score_job(spark, a.lake, a.batch, a.models, a.reports)
    elif a.cmd == "stream-load":
        trig = {"processingTime": a.every} if a.every else None
        jobs.stream_load_job(spark, a.lake, a.target, a.checkpoint, trig,
                             max_files_per_trigger=a.max_files).awaitTermination()


if __name__ == "__main__":
    main()
