"""Jobs to submit: `spark-submit ... -m candlewick <job> ...`, or `python -m candlewick <job> ...`.

route     raw JSON lines -> trade topic and dead-letter topic
live      trade topic -> Bronze files, bars, signals and alerts
backfill  Bronze files -> bars, signals and alerts, in one scan
compact   fold the versions of the bar, signal, alert and health tables, dropping rows past their retention
expire    drop the days past their retention from these tables, by folder, without reading the rest
"""

import argparse
import logging
from datetime import datetime, timezone

from candlewick import schemas, settings
from candlewick.operators.ingest import check, with_event_time
from candlewick.plans.backfill import backfill
from candlewick.session import build_session, stream_session
from candlewick.sinks.keyed import alert_table, bar_table, health_table, signal_table
from candlewick.sinks.topic import write_checked
from candlewick.sources.bronze import read_bronze, read_days
from candlewick.sources.topic import read_raw_messages
from candlewick.streaming.progress import JobLog
from candlewick.streaming.jobs import JobPaths, await_any, live_trades, seed_health, start_all, start_health, start_panes, start_rsi


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="candlewick", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *, topic: bool) -> argparse.ArgumentParser:
        options = jobs.add_parser(name)
        options.add_argument("--root", required=True, help="folder of the tables, on shared storage")
        options.add_argument("--checkpoints", default="", help="folder of the stream checkpoints")
        options.add_argument("--once", action="store_true", help="process what is there, then stop")
        if topic:
            options.add_argument("--kind", choices=("kafka", "files"), default="kafka")
            options.add_argument("--servers")
            options.add_argument("--state-partitions", type=int, help="fixed by the first checkpoint; default: one per core")
        return options

    route = job("route", topic=True)
    route.add_argument("--feed", required=True, help="folder of JSON lines")
    route.add_argument("--path", help="topic folder, for files")
    route.add_argument("--component", default="producer", help="name of this job in the health table")
    route.add_argument(
        "--max-ahead-ms", type=int, default=settings.MAX_AHEAD_MS,
        help="a trade time further ahead of its receipt makes a message a dead letter; below 0: never",
    )
    live = job("live", topic=True)
    live.add_argument("--topic", default=settings.TRADES_TOPIC)
    live.add_argument("--path", help="folder of the trade topic, for files")
    live.add_argument("--max-per-trigger", type=int, help="offsets or files per batch")
    live.add_argument("--starting-offsets", default="latest")
    live.add_argument("--skip-lost-offsets", action="store_true", help="go on where the broker has lost messages")
    live.add_argument("--alerts", action="store_true", help="also keep the alert history")
    live.add_argument("--latest", action="store_true", help="also keep each symbol's newest signal")
    live.add_argument("--rsi", action="store_true", help="also follow the strength index of closed bars")
    live.add_argument("--panes", action="store_true", help="also keep the panes sliding bars are made of")
    past = job("backfill", topic=False)
    past.add_argument("--days", nargs="*", help="trade days as yyyy/MM/dd; all when left out")
    past.add_argument("--name", help="the same name again replaces what it wrote before; by default made of the days")
    job("compact", topic=False)
    job("expire", topic=False)
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = _arguments(given)
    spark = build_session(f"candlewick-{options.job}")
    if options.job in ("route", "live"):
        spark = stream_session(spark, options.state_partitions)
        spark.streams.addListener(JobLog())
    paths = JobPaths(options.root, options.checkpoints)
    trigger = {"availableNow": True} if options.once else None
    queries = []
    if options.job == "route":
        ahead = options.max_ahead_ms if options.max_ahead_ms >= 0 else None
        checked = check(read_raw_messages(spark, options.feed, stream=True), max_ahead_ms=ahead)
        queries.append(
            write_checked(
                checked,
                kind=options.kind,
                servers=options.servers,
                path=options.path,
                checkpoint=paths.checkpoint("route"),
                trigger=trigger,
            )
        )
        seed_health(spark, paths)
        queries.append(start_health(checked, paths, trigger, options.component))
    elif options.job == "live":
        source = {"kind": options.kind, "max_per_trigger": options.max_per_trigger}
        if options.kind == "kafka":
            source |= {"servers": options.servers, "topic": options.topic, "starting_offsets": options.starting_offsets}
            source |= {"fail_on_data_loss": not options.skip_lost_offsets}
        else:
            source |= {"path": options.path}
        queries = start_all(spark, paths, trigger, options.alerts, options.latest, **source)
        if options.rsi:
            queries.append(start_rsi(live_trades(spark, schemas.SILVER_INPUT, **source), paths, trigger))
        if options.panes:
            queries.append(start_panes(live_trades(spark, schemas.SILVER_INPUT, **source), paths, trigger))
    elif options.job == "backfill":
        stored = read_days(spark, paths.bronze, options.days) if options.days else read_bronze(spark, paths.bronze)
        # Each choice of days is a batch of its own.
        name = options.name or "-".join(["backfill", *[day.replace("/", "") for day in options.days or ()]])
        print(backfill(with_event_time(stored), paths, name, options.days))
    else:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        tables = {"bars": bar_table, "signals": signal_table, "alerts": alert_table, "health": health_table}
        for name, table in tables.items():
            if options.job == "expire":
                print(f"{name}: {table(getattr(paths, name)).expire(spark, settings.RETENTION_DAYS[name], now)}")
                continue
            last = table(getattr(paths, name)).compact(spark, settings.RETENTION_DAYS[name], now)
            print(f"{name}: base version {last}")
    if options.once:
        for query in queries:
            query.awaitTermination()
    elif queries:
        await_any(spark)


if __name__ == "__main__":
    main()
