"""Command line of the jobs: ``spark-submit submit.py <job> ...``."""

from __future__ import annotations

import argparse
import os
from datetime import UTC, datetime
from functools import partial

from tallystream.functions import parse_envelope
from tallystream.operators import BROADCAST_LIMIT, hot_athletes
from tallystream.operators.enrich import SPREAD
from tallystream.plans import (
    Journal,
    Layers,
    run_bronze,
    run_gold,
    run_medallion,
    run_silver,
    run_silver_increment,
)
from tallystream.plans.medallion import RESULTS
from tallystream.schemas import ENRICHED_TALLY, RESULT_EVENT, STAMPED_TALLY
from tallystream.session import build_session
from tallystream.sinks import JdbcLedger, jdbc_sink, log_sink, replay_publish, topic_sink
from tallystream.sources import Database, jdbc_scan, kafka_topic, read_topic, stream_topic
from tallystream.streaming import (
    MetricsLog,
    enrichment_stream,
    follow_topic,
    keep_enriching,
    split_topic,
)

STAGES = ("bronze", "silver", "gold", "medallion")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="submit.py", description=__doc__)
    parser.add_argument("--shuffle-partitions", type=int, help="also the state-store partitions")
    parser.add_argument("--initial-partitions", type=int, help="of batch shuffles, before merging")
    jobs = parser.add_subparsers(dest="job", required=True)

    for stage in STAGES:
        job = jobs.add_parser(stage, help=f"batch stage: {stage}")
        job.add_argument("base", help="folder that holds the layers")
        job.add_argument("--run-ts", type=datetime.fromisoformat, default=datetime.now(UTC))
        if stage in ("silver", "medallion"):
            job.add_argument("--snapshots", choices=("all", "latest"), default="all")
        if stage == "gold":
            job.add_argument("--missing", choices=("raise", "skip"), default="raise")
        job.add_argument("--preview", type=int, default=10, metavar="ROWS")
        if stage != "bronze":
            job.add_argument(
                "--versions-only",
                action="store_true",
                help="leave days where they were written, for stores that rename by copying",
            )
        if stage != "medallion":
            job.add_argument(
                "--resume", action="store_true", help="pass over what this --run-ts has finished"
            )

    job = jobs.add_parser("increment", help="clean the snapshots that no earlier run has")
    job.add_argument("base", help="folder that holds the layers")
    job.add_argument("--table", default=RESULTS)

    topics = argparse.ArgumentParser(add_help=False)
    topics.add_argument("--servers", required=True)
    topics.add_argument("--security-protocol", default="PLAINTEXT")
    topics.add_argument(
        "--tolerate-data-loss", action="store_true", help="go on when records expired unread"
    )
    topics.add_argument("--max-offsets-per-trigger", type=int, help="records of a micro-batch")
    topics.add_argument("--min-partitions", type=int, help="tasks that read the topic")
    database = argparse.ArgumentParser(add_help=False)
    database.add_argument("--jdbc-url", required=True)
    database.add_argument("--jdbc-driver", required=True)
    database.add_argument("--jdbc-user", default="")
    database.add_argument("--jdbc-password-env", default="", help="variable with the password")
    database.add_argument("--partition-column", help="numeric column to split table reads by")
    database.add_argument("--partitions", type=int, help="tasks that read a table")

    job = jobs.add_parser("publish", parents=[topics, database], help="replay a table into a topic")
    job.add_argument("--table", default="athlete_event_results")
    job.add_argument("--single-task", action="store_true", help="read the table in one task")
    job.add_argument("--topic", required=True)

    job = jobs.add_parser("enrich", parents=[topics, database], help="the continuous enrichment")
    job.add_argument("--topic", required=True)
    job.add_argument("--starting-offsets", default="earliest")
    job.add_argument("--bio-table", default="athlete_bio")
    job.add_argument("--output-topic", required=True)
    job.add_argument("--output-table", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument(
        "--once",
        action="store_true",
        help="deliver each row once: records are stamped, and rows reach the table through a "
        "staging table and a marker per batch, which the job creates",
    )
    job.add_argument("--job-number", type=int, default=0, help="with --once: another for each checkpoint")
    job.add_argument("--replan-seconds", type=float, default=3600.0)
    job.add_argument(
        "--find-hot",
        action="store_true",
        help="if the biographies are too large to broadcast, count the topic's records per "
        "athlete, to salt the dominant ones only",
    )
    job.add_argument("--broadcast-limit", type=int, default=BROADCAST_LIMIT, metavar="BYTES")
    job.add_argument("--spread", type=int, default=SPREAD, help="salts of an athlete")
    job.add_argument(
        "--profiles",
        help="folder of this job alone for biographies too large to broadcast, renewed every "
        "--replan-seconds; without it every micro-batch reads the table",
    )
    job.add_argument(
        "--profile-buckets", type=int, help="buckets of that folder, for micro-batches that move only records"
    )
    job.add_argument("--metrics", help="folder for the counts of each micro-batch")
    job.add_argument("--preview", type=int, default=20, metavar="ROWS")

    job = jobs.add_parser("follow", parents=[topics], help="store the decoded records of a topic")
    job.add_argument("--topic", required=True)
    job.add_argument("--records", choices=("results", "tallies"), default="results")
    job.add_argument("--output", required=True, help="folder for the records, as Parquet")
    job.add_argument(
        "--once-within", metavar="DURATION", help="drop stamped tallies that were sent twice so far apart"
    )
    job.add_argument("--checkpoint", required=True)

    job = jobs.add_parser("quarantine", parents=[topics], help="store the unreadable records of a topic")
    job.add_argument("--topic", required=True)
    job.add_argument("--records", choices=("results", "tallies"), default="results")
    job.add_argument("--output", required=True, help="folder, one partition per micro-batch")
    job.add_argument("--accepted", help="folder for the readable records, stored in the same pass")
    job.add_argument("--required", nargs="*", default=["athlete_id"], help="fields that must be there")
    job.add_argument("--checkpoint", required=True)
    return parser


def _database(args: argparse.Namespace) -> Database:
    password = os.environ[args.jdbc_password_env] if args.jdbc_password_env else ""
    return Database(args.jdbc_url, args.jdbc_driver, args.jdbc_user, password)


def _topic(args: argparse.Namespace, name: str, **options):
    sizes = {
        "maxOffsetsPerTrigger": args.max_offsets_per_trigger,
        "minPartitions": args.min_partitions,
    }
    given = {k: str(v) for k, v in sizes.items() if v is not None}
    return kafka_topic(
        args.servers,
        name,
        security_protocol=args.security_protocol,
        fail_on_data_loss=not args.tolerate_data_loss,
        read_options=given,
        **options,
    )


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(
        f"tallystream-{args.job}",
        shuffle_partitions=args.shuffle_partitions,
        initial_partitions=args.initial_partitions,
    )
    if args.job in STAGES:
        layers = Layers.below(args.base, plain=not getattr(args, "versions_only", False))
        resume = getattr(args, "resume", False)
        journal = Journal(spark, layers.run_journal(args.run_ts)) if resume else None
        options = {"preview_rows": args.preview, "journal": journal}
        if args.job == "bronze":
            run_bronze(spark, layers, args.run_ts, **options)
        elif args.job == "silver":
            run_silver(spark, layers, args.run_ts, snapshots=args.snapshots, **options)
        elif args.job == "gold":
            run_gold(spark, layers, args.run_ts, missing=args.missing, **options)
        else:
            run_medallion(
                spark, layers, args.run_ts, args.snapshots, preview_rows=args.preview
            )
    elif args.job == "increment":
        print(run_silver_increment(spark, Layers.below(args.base), args.table) or "nothing new")
    elif args.job == "publish":
        if args.partition_column is None and not args.single_task:
            raise SystemExit("publish: give --partition-column, or --single-task for a small table")
        table = jdbc_scan(
            spark,
            _database(args),
            args.table,
            partition_column=args.partition_column,
            partitions=args.partitions,
        )
        replay_publish(table, _topic(args, args.topic))
    elif args.job == "enrich":
        database = _database(args)
        source = _topic(args, args.topic, starting_offsets=args.starting_offsets)
        if args.once:
            table_sink = JdbcLedger(database, args.output_table, job=args.job_number)
        else:
            table_sink = jdbc_sink(database, args.output_table)
        sinks = [topic_sink(_topic(args, args.output_topic), stamped=args.once), table_sink]

        def define():
            biography = jdbc_scan(
                spark,
                database,
                args.bio_table,
                partition_column=args.partition_column,
                partitions=args.partitions,
            )
            hot = None
            if args.find_hot:
                records = parse_envelope(read_topic(spark, source), RESULT_EVENT, ["athlete_id"])
                hot = partial(hot_athletes, records)
            return enrichment_stream(
                stream_topic(spark, source),
                biography,
                broadcast_limit=args.broadcast_limit,
                spread=args.spread,
                hot=hot,
                profiles=args.profiles,
                profile_buckets=args.profile_buckets,
                metrics="enrichment" if args.metrics else None,
            )

        if args.metrics:
            spark.streams.addListener(MetricsLog(spark, args.metrics, "enrichment"))

        keep_enriching(
            define,
            sinks,
            args.checkpoint,
            seconds=args.replan_seconds,
            preview_rows=args.preview,
        )
    else:
        once = getattr(args, "once_within", None)
        tallies = STAMPED_TALLY if once else ENRICHED_TALLY
        schema = RESULT_EVENT if args.records == "results" else tallies
        records = stream_topic(spark, _topic(args, args.topic))
        if args.job == "quarantine":
            accepted = log_sink(args.accepted) if args.accepted else None
            split_topic(
                records, schema, accepted, log_sink(args.output), args.checkpoint, required=args.required
            ).awaitTermination()
            return
        follow_topic(
            records, schema, args.checkpoint, args.output, once_within=once
        ).awaitTermination()
