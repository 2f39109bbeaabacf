"""Command line: run one dataset as a batch job, or list them.

    python -m tidemart.cli list
    python -m tidemart.cli run dws_trade_sku_order --input /data/tables --output /data/out/sku
    python -m tidemart.cli explain dws_trade_sku_order --input /data/tables
    python -m tidemart.cli warehouse --input /data/tables --root /shared/warehouse
    python -m tidemart.cli run-job log_split --source /data/topic_log --output /data/out --sink json
    python -m tidemart.cli run-job dws_home_detail_uv --source /data/out/page --output /data/uv --mode stream --trigger 3s

``--input`` holds the source tables as ``<name>.parquet``; ``--output`` is
written as parquet (``--partition-by cur_date`` for the metric tables).
``run-job`` runs a job on a real topic (:mod:`tidemart.topics`), as a batch or
as a stream.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    wp = sub.add_parser("warehouse")
    wp.add_argument("--input", required=True)
    wp.add_argument("--root", default=None, help="default: <spark.checkpoint.dir>/warehouse")
    wp.add_argument("--partition-metrics", action="store_true", help="partition metric tables by cur_date")
    wp.add_argument("--master", default=None)
    wp.add_argument("--tz", default="UTC")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("dataset")
        p.add_argument("--input", required=True)
        p.add_argument("--output")
        p.add_argument("--partition-by")
        p.add_argument("--master", default=None)
        p.add_argument("--tz", default="UTC")
    p = sub.add_parser("run-job", help="run a job on a topic")
    p.add_argument("dataset")
    p.add_argument("--source", required=True, help="folder of lines, or Kafka topic")
    p.add_argument("--output", required=True)
    p.add_argument("--mode", choices=("batch", "stream"), default="batch")
    p.add_argument("--format", default="text", choices=("text", "kafka"))
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader / writer option")
    p.add_argument("--sink", choices=("parquet", "json", "kafka", "olap"), default="parquet")
    p.add_argument("--dictionary", help="base_dic as parquet")
    p.add_argument("--dims", help="folder of dimension tables")
    p.add_argument("--config", help="dimension configuration changes as parquet")
    p.add_argument("--details", help="order detail lines, for the payment join")
    p.add_argument("--changelog", help="pre-process topic, for order and cancel details")
    p.add_argument("--visitors", help="unique-visitor topic, for the traffic metric")
    p.add_argument("--bounces", help="bounce topic, for the traffic metric")
    p.add_argument("--checkpoint", help="folder all executors share, for offsets and state (default: spark.checkpoint.dir)")
    p.add_argument("--lateness", type=int, metavar="SECONDS", help="traffic metric from topics: how late rows may be (default 10, "
                   "as the micro-batches' span of event time in a backfill)")
    p.add_argument("--trigger", metavar="INTERVAL", help="stream: run on and take what arrives, e.g. every 3s (default: take what is there and stop)")
    p.add_argument("--max-files", type=int, help="stream: files a trigger takes at most")
    p.add_argument("--max-bytes", help="stream: bytes a trigger takes at most, e.g. 10g")
    p.add_argument("--max-offsets", type=int, help="stream: Kafka records a trigger takes at most")
    p.add_argument("--stop-file", help="stream: stop between two batches when this path appears (SIGTERM does the same)")
    p.add_argument("--run-for", type=float, metavar="SECONDS", help="stream: stop after this time")
    p.add_argument("--master", default=None)
    p.add_argument("--tz", default="UTC")
    a = ap.parse_args(argv)

    from .plans.registry import QUERIES
    if a.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    from pyspark.sql import SparkSession
    from .session import DEFAULT_CONF, ship_package
    b = SparkSession.builder.appName(f"tidemart-{getattr(a, 'dataset', a.cmd)}")
    if a.master:
        b = b.master(a.master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.config("spark.sql.session.timeZone", a.tz).getOrCreate()
    ship_package(spark)
    if a.cmd == "run-job":
        from . import topics
        if a.checkpoint:
            spark.conf.set("spark.checkpoint.dir", a.checkpoint)
        limits = {"maxFilesPerTrigger": a.max_files, "maxBytesPerTrigger": a.max_bytes, "maxOffsetsPerTrigger": a.max_offsets}
        inputs = topics.Inputs(spark, a.source, a.format, a.mode == "stream", dict(o.split("=", 1) for o in a.option),
                               a.dictionary, a.dims, a.config, a.details, a.tz, {k: str(v) for k, v in limits.items() if v},
                               a.changelog, a.visitors, a.bounces, 10 if a.lateness is None else a.lateness)
        from .streaming import runtime
        runtime.wait(spark, topics.run(inputs, a.dataset, a.output, a.sink, a.trigger), a.stop_file, a.run_for)
        return 0
    if a.cmd == "warehouse":
        from .plans import warehouse
        for name, path in warehouse.build(spark, a.input, a.root, a.partition_metrics).items():
            print(name, path)
        return 0
    df = QUERIES[a.dataset](spark, a.input)
    if a.cmd == "explain":
        df.explain("formatted")
        return 0
    if not a.output:
        ap.error("--output is required for run")
    w = df.write.mode("overwrite")
    if a.partition_by:
        w = w.partitionBy(a.partition_by)
    w.parquet(a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
