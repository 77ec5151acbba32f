"""Command line: run one of the jobs as a stream (or once, as a batch).

    python -m skytally carriers-by-airport --files /data/incoming \
        --table /shared/results/top_carriers --checkpoint /shared/ckpt/top_carriers
    python -m skytally airports --kafka broker1:9092,broker2:9092 --topics flights,more \
        --table ... --checkpoint ... --trigger-seconds 2
    python -m skytally carriers-by-route --batch /data/flights --table /shared/results/routes_once

Streams run until stopped (or, with ``--available-now``, until the input seen
at start is consumed). Results go to ``--table`` as Parquet snapshots or change logs; read
them with ``skytally.streaming.changelog.read_latest``, and the counts of ``--ranked --mode
update`` with their ranks by ``skytally.streaming.runner.read_ranked``.
"""

from __future__ import annotations

import argparse
import sys
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from skytally.operators import rejects, strict, top_n
from skytally.operators.topk import DEFAULT_K
from skytally.plans import layout as L
from skytally.plans import queries as Q
from skytally.sources import file_line_stream, kafka_line_stream, text_lines
from skytally.sources.lines import TRIGGER_SECONDS
from skytally.streaming import runner as R
from skytally.streaming.accounts import Accounts, accounted
from skytally.streaming.changelog import DEFAULT_KEEP_VERSIONS, write_once


def _counts(runner, batch, ranked):
    def stream(lines, table, ckpt, trigger, args):
        return runner(lines, table, ckpt, trigger, mode=args.mode or "complete", ranked=args.ranked, top=args.top,
                      post=L.counts_layout if args.original_layout else None, keep_versions=args.keep_versions, show=args.print)

    def once(lines, args):
        out = ranked(lines) if args.ranked else batch(lines)
        if args.top is not None:
            out = top_n(out, args.top)
        return L.counts_layout(out) if args.original_layout else out
    return stream, once


def _grouped(spec):
    def stream(lines, table, ckpt, trigger, args):
        return R.grouped_top_k_stream(lines, spec, table, ckpt, trigger, k=args.top or DEFAULT_K, mode=args.mode or "complete",
                                      layout="original" if args.original_layout else "long", keep_versions=args.keep_versions, show=args.print)

    def once(lines, args):
        k = args.top or DEFAULT_K
        return (L.lists_layout(Q.packed_top_k(lines, spec, k), spec.group_cols) if args.original_layout
                else Q.grouped_top_k(lines, spec, k))
    return stream, once


def _itineraries():
    def stream(lines, table, ckpt, trigger, args):
        return R.itinerary_stream(lines, table, ckpt, trigger, mode=args.mode or "update",
                                  post=L.itineraries_layout if args.original_layout else None,
                                  keep_versions=args.keep_versions, show=args.print)

    def once(lines, args):
        out = Q.best_itineraries(lines)
        return L.itineraries_layout(out) if args.original_layout else out
    return stream, once


# job name -> (streaming runner, batch query)
JOBS = {
    "airports": _counts(R.airport_popularity_stream, Q.airport_popularity, Q.airports_ranked),
    "carriers": _counts(R.carrier_on_time_stream, Q.carrier_on_time_arrivals, Q.carriers_ranked),
    "carriers-by-airport": _grouped(Q.CARRIERS_BY_AIRPORT),
    "destinations-by-airport": _grouped(Q.DESTINATIONS_BY_AIRPORT),
    "carriers-by-route": _grouped(Q.CARRIERS_BY_ROUTE),
    "itineraries": _itineraries(),
}


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m skytally", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=sorted(JOBS))
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--files", help="directory of text files to stream (new files are picked up)")
    src.add_argument("--kafka", help="bootstrap servers, comma separated")
    src.add_argument("--batch", help="text files to process once as a batch")
    p.add_argument("--topics", help="Kafka topics, comma separated (with --kafka)")
    p.add_argument("--group", help="Kafka consumer group id prefix (offsets themselves live in the checkpoint)")
    p.add_argument("--starting-offsets", default="latest", help="Kafka start: latest (default) or earliest")
    p.add_argument("--kafka-partitions", type=int, default=None,
                   help="minimum Spark partitions for the Kafka source (threads per topic)")
    p.add_argument("--max-per-trigger", type=int, default=None, help="Kafka records per trigger of the whole query (default: no cap)")
    p.add_argument("--files-per-trigger", type=int, default=1)
    p.add_argument("--bytes-per-trigger", help="input size per trigger, e.g. 512m, instead of a number of files (with --files)")
    p.add_argument("--archive-dir", help="move processed input files here (with --files)")
    p.add_argument("--table", required=True, help="result table directory")
    p.add_argument("--checkpoint", help="streaming checkpoint directory (required for streams)")
    p.add_argument("--trigger-seconds", type=float, default=TRIGGER_SECONDS)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--mode", choices=["complete", "update"], help="default: complete; itineraries: update")
    p.add_argument("--ranked", action="store_true", help="airports, carriers: every key with its rank (update mode: when read)")
    p.add_argument("--top", type=int, help="airports, carriers: only the n highest (complete mode); the grouped jobs: n per group")
    p.add_argument("--print", type=int, nargs="?", const=10, default=0, metavar="N", help="also print N rows (10) per trigger")
    p.add_argument("--keep-versions", type=int, default=DEFAULT_KEEP_VERSIONS, help="snapshots to keep (complete mode)")
    p.add_argument("--original-layout", action="store_true",
                   help="write (Id, Popularity), (Airport, CarriersList) or (Id, CarriersList) rows like the original tables")
    p.add_argument("--rejects", help="folder for the lines the job can't use, with their reason")
    p.add_argument("--account", action="store_true", help="print the numbers of used and rejected lines, by reason, per trigger")
    p.add_argument("--state-on-disk", action="store_true", help="keep running counts in RocksDB instead of the executors' memory")
    p.add_argument("--failfast", action="store_true", help="fail on the first line the job can't use")
    return p


def run(spark: SparkSession, argv: list[str]) -> DataFrame | None:
    """Start the job described by ``argv``; waits for streams to end. Returns the batch result."""
    return run_args(spark, build_parser().parse_args(argv))


def run_args(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    start_fn, batch_fn = JOBS[args.job]
    if (args.ranked or args.top is not None) and args.job == "itineraries":
        raise SystemExit("--ranked and --top don't apply to itineraries")
    if args.ranked and (args.job not in ("airports", "carriers") or args.top is not None or args.original_layout):
        raise SystemExit("--ranked is for airports and carriers, without --top or --original-layout")
    if args.mode == "update" and args.top is not None and args.job in ("airports", "carriers"):
        raise SystemExit("--top is cut from every key each trigger: use --mode complete, or --ranked --mode update")
    if args.batch:
        lines = text_lines(spark, args.batch)
        out = batch_fn(strict(lines, args.job) if args.failfast else lines, args)
        try:
            write_once(out, args.table)
        except ValueError as e:
            raise SystemExit(str(e)) from e
        if args.rejects:
            rejects(lines, args.job).write.mode("append").parquet(args.rejects)
        if args.print:
            out.show(args.print, truncate=False)
        return out
    if not args.checkpoint:
        raise SystemExit("--checkpoint is required for a stream")
    if args.kafka:
        if not args.topics:
            raise SystemExit("--topics is required with --kafka")
        lines = kafka_line_stream(spark, args.kafka, args.topics, starting_offsets=args.starting_offsets,
                                  max_offsets_per_trigger=args.max_per_trigger,
                                  min_partitions=args.kafka_partitions, group_id_prefix=args.group)
    else:
        lines = file_line_stream(spark, args.files, args.files_per_trigger, max_bytes_per_trigger=args.bytes_per_trigger,
                                 clean_source="archive" if args.archive_dir and not args.rejects else None,
                                 archive_dir=args.archive_dir if not args.rejects else None)
        if args.archive_dir and args.rejects:
            raise SystemExit("--archive-dir would move files that the reject stream still reads: leave one out")
    every = f"{int(round(args.trigger_seconds * 1000))} milliseconds"
    trigger = {"availableNow": True} if args.available_now else {"processingTime": every}
    used = strict(lines, args.job) if args.failfast else lines
    accounts = Accounts(show=True)
    if args.account:
        used = accounted(used, args.job)
        spark.streams.addListener(accounts)
    with R.state_on_disk(spark) if args.state_on_disk else nullcontext():
        queries = [start_fn(used, args.table, args.checkpoint, trigger, args)]
    if args.rejects:
        queries.append(R.reject_stream(lines, args.job, args.rejects, args.checkpoint.rstrip("/") + "_rejects", trigger))
    try:
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(1) if len(queries) > 1 else queries[0].awaitTermination()
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()
        if args.account:
            spark.streams.removeListener(accounts)
    return None


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(list(sys.argv[1:] if argv is None else argv))  # before starting Spark
    spark = (SparkSession.builder.appName(f"skytally-{args.job}")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    run_args(spark, args)


if __name__ == "__main__":
    main()
