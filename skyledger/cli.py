"""Command line: ``spark-submit`` or ``python -m skyledger`` with one of the subcommands.

    load     raw monthly files of some years -> clean table by year
    extract  flights -> headerless 13- or 14-field text
    audit    good and total line counts of the input
    publish  flights -> messages on a topic
    relay    messages of one topic -> another
    run      a batch report on flights -> text or Parquet
    stream   a running report on a topic -> keyed table, text report or console
    lookup   keys of a result table -> printed lines
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators import filters, lookup, ranking, trips
from skyledger.plans.batch import METRICS, RANKINGS, REPORTS
from skyledger.schema import RAW_COLUMNS, TABLES
from skyledger.session import build_session, folders
from skyledger.sources import extract, messages, raw, tables, yearly
from skyledger.streaming import running
from skyledger.streaming import trips as trip_streams
from skyledger.streaming.sinks import FAIL, RESET, BucketedTable

LAYOUTS = ("table", "raw", "raw-headerless", "extract13", "extract14")
TRIP_REPORTS = ("best_trips", "all_trips")
TRIP_STREAMS = ("all-trips", "best-trips")
STREAM_JOBS = (
    *running.TABLE_JOBS, *running.RANKING_JOBS, *TRIP_STREAMS, "word-count",
)


def years(text: str) -> list[int]:
    """``1988-1998`` or ``1999,2001`` or the names ``first``, ``last`` and ``all``."""
    named = {
        "first": yearly.FIRST_YEARS, "last": yearly.LAST_YEARS, "all": yearly.ALL_YEARS,
    }
    if text in named:
        return list(named[text])
    found: list[int] = []
    for part in text.split(","):
        start, _, end = part.partition("-")
        found.extend(range(int(start), int(end or start) + 1))
    return found


def options(pairs: Sequence[str]) -> dict[str, str]:
    """``name=value`` pairs for a source or sink."""
    return dict(pair.split("=", 1) for pair in pairs)


def read_flights(spark: SparkSession, args: argparse.Namespace, years: list[int] | None):
    """The flights of whichever layout, of whole files or directories of the years."""
    if args.layout == "table":
        return yearly.read_years(spark, args.input, years)
    if args.layout.startswith("raw"):
        paths = raw.raw_paths(args.input, years) if years else args.input
        columns = args.columns.split(",") if args.columns else RAW_COLUMNS
        return raw.read_flights(spark, paths, args.layout == "raw", columns)
    return extract.read_extract(spark, args.input, int(args.layout[-2:]))


def read_input(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The input flights, of the given years and dates."""
    flights = read_flights(spark, args, args.years)
    if args.dates:
        flights = filters.on_dates(flights, args.dates.split(","))
    return flights


def trips_report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Trips that start in the given years and on the given dates.

    Second legs are two days later, so the year after is read, too, where there is one.
    """
    years = args.years
    if years:
        after = sorted({y + 1 for y in years} - set(years))
        if args.layout.startswith("raw"):
            held = folders(spark, args.input)
            after = [y for y in after if any(fnmatch(x, raw.FILE_PATTERN.format(year=y)) for x in held)]
        years = [*years, *after]
    flights = flown(read_flights(spark, args, years), args.keep_diverted)
    report = REPORTS[args.report]
    if args.dates:
        return trips.starting_on(report, flights, args.dates.split(","))
    return trips.starting_in(report, flights, args.years) if args.years else report(flights)


def flown(flights: DataFrame, keep_diverted: bool) -> DataFrame:
    """Flights that count; tables and extracts without flags hold only such flights."""
    if "cancelled" not in flights.columns:
        return flights
    return filters.not_cancelled(flights) if keep_diverted else filters.clean(flights)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.dates:
        raise SystemExit("load replaces whole months; --dates would leave parts of them")
    flights = flown(read_input(spark, args), args.keep_diverted)
    written = yearly.write_years(flights, args.out)
    print(f"{written['rows']} flights written")


def write_extract(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = flown(read_input(spark, args), args.keep_diverted)
    extract.write_layout(flights, args.out, args.fields)


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    row = filters.audit(read_input(spark, args), filters.bad_times()).first()
    print(
        f"{row.all_lines} lines, {row.good_lines} of them good, "
        f"{row.unknown_lines} without readable flags, {row.bad_times} without a readable departure"
    )


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = flown(read_input(spark, args), keep_diverted=False)
    sent = messages.publish(filters.message_value(flights), args.transport, **options(args.option))
    if args.close:
        sent += messages.publish(messages.closing_messages(spark, args.close), args.transport, **options(args.option))
    print(f"{sent} messages published")


def relay(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = messages.read_messages(spark, args.transport, **options(args.option))
    messages.publish_stream(
        lines, args.checkpoint, args.transport, **options(args.to)
    ).awaitTermination()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.report in TRIP_REPORTS:
        rows = trips_report(spark, args)
    else:
        flights = flown(read_input(spark, args), args.keep_diverted)
        report = REPORTS[args.report]
        rows = report(flights, n=args.n) if args.report in RANKINGS else report(flights)
    if args.table:
        tables.write_table(tables.as_table(rows, TABLES[args.table]), TABLES[args.table], args.out)
    elif args.out:
        tables.write_text(rows, args.out)
    else:
        if args.report not in RANKINGS:
            rows = rows.orderBy(*rows.columns)
        shown = rows.limit(args.n + 1).collect()
        for row in shown[: args.n]:
            print("\t".join(map(str, row)))
        if len(shown) > args.n:
            print(f"... the first {args.n} rows; --out writes all, --n shows more")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    source = options(args.option)
    if args.limit:
        seconds = float(args.every.split()[0]) if args.every else running.BATCH_SECONDS
        source |= messages.feed_limit(args.transport, seconds, args.limit)
    lines = messages.read_messages(spark, args.transport, **source)
    trigger = {"processingTime": args.every} if args.every else None
    if args.once:
        trigger = running.AVAILABLE_NOW
    query = _start(spark, args, lines, trigger)
    query.awaitTermination()
    if args.job in TRIP_STREAMS and (late := trip_streams.late_rows(query)):
        print(f"{late} legs came later than {args.max_disorder or trip_streams.MAX_DISORDER} and were left out")


def _heavy(spark: SparkSession, args: argparse.Namespace) -> list[trip_streams.HeavyKey]:
    """Keys to spread, as found in a table of flights like those to come."""
    return trip_streams.heavy_keys(yearly.read_years(spark, args.heavy_from)) if args.heavy_from else []


def _start(spark: SparkSession, args: argparse.Namespace, lines: DataFrame, trigger):
    if args.job == "word-count":
        return running.count_words_per_batch(
            lines, args.out, args.checkpoint, trigger, args.existing
        )
    flights = messages.parse(lines)
    if args.job == "all-trips":
        return trip_streams.keep_all_trips(
            flights, args.out, args.checkpoint, trigger, _heavy(spark, args), args.max_disorder,
            args.existing,
        )
    if args.job == "best-trips":
        return trip_streams.keep_best_trips(
            flights, args.out, args.checkpoint, trigger,
            args.max_disorder or trip_streams.MAX_DISORDER, args.existing,
        )
    if args.job in running.TABLE_JOBS:
        table = running.TABLE_JOBS[args.job][0]
        target = BucketedTable(spark, table, args.out, existing=args.existing)
        return running.keep_table(args.job, flights, target, args.checkpoint, trigger)
    if args.out:
        return running.keep_report(args.job, flights, args.out, args.checkpoint, trigger)
    return running.show_top(args.job, flights, args.checkpoint, args.n, trigger)


def look_up(spark: SparkSession, args: argparse.Namespace) -> None:
    table = TABLES[args.table]
    if args.streamed:
        rows = BucketedTable(spark, table, args.input).read()
    else:
        rows = tables.read_table(spark, table, args.input)
    keys = args.keys.split(",")
    if args.table == "route_delay":
        found = lookup.routes(rows, [tuple(key.split(":")) for key in keys])
    else:
        found = lookup.best_of(rows, table, keys, args.n)
    # At most n lines per asked key, so the driver can print them.
    for row in lookup.report_lines(found, table).collect():
        print(row.line)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skyledger")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, action, flights: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(action=action)
        if flights:
            sub.add_argument("--input", required=True)
            sub.add_argument("--layout", choices=LAYOUTS, default="table")
            sub.add_argument("--years", type=years)
            sub.add_argument("--dates", help="of trips, the dates of the first leg")
            sub.add_argument("--columns", help="names by position, for raw-headerless")
            sub.add_argument("--keep-diverted", action="store_true")
        return sub

    command("load", load, flights=True).add_argument("--out", required=True)

    sub = command("extract", write_extract, flights=True)
    sub.add_argument("--fields", type=int, choices=(13, 14), default=13)
    sub.add_argument("--out", required=True)

    command("audit", audit, flights=True)

    sub = command("publish", publish, flights=True)
    sub.add_argument("--close", type=dt.date.fromisoformat, help="then close all dates well before this one for best-trips")
    sub.add_argument("--transport", default="kafka")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    sub = command("relay", relay)
    sub.add_argument("--transport", default="kafka")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    sub.add_argument("--to", action="append", default=[], metavar="NAME=VALUE")
    sub.add_argument("--checkpoint", required=True)

    sub = command("run", run, flights=True)
    sub.add_argument("report", choices=sorted((*METRICS, *RANKINGS)))
    sub.add_argument("--n", type=int, default=ranking.DEFAULT_N)
    sub.add_argument("--out")
    sub.add_argument("--table", choices=sorted(TABLES))

    sub = command("stream", stream)
    sub.add_argument("job", choices=sorted(STREAM_JOBS))
    sub.add_argument("--transport", default="kafka")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--out")
    sub.add_argument("--n", type=int, default=ranking.DEFAULT_N)
    sub.add_argument("--once", action="store_true", help="stop when everything is read")
    sub.add_argument("--every", help="time between micro-batches, e.g. '2 seconds'")
    sub.add_argument("--limit", type=int, help="bytes of files or broker messages a second")
    sub.add_argument(
        "--existing", choices=(RESET, FAIL), default=RESET,
        help="when a new stream finds what another one wrote",
    )
    sub.add_argument("--heavy-from", help="a flight table whose heavy stopovers all-trips spreads")
    sub.add_argument("--max-disorder", help="drop older legs from state, e.g. '33 days'")

    sub = command("lookup", look_up)
    sub.add_argument(
        "table",
        choices=(
            "carrier_performance", "carrier_delay", "destination_performance",
            "destination_delay", "route_delay",
        ),
    )
    sub.add_argument("--input", required=True)
    sub.add_argument("--keys", required=True, help="SRQ,CMH or LGA:BOS,BOS:LGA")
    sub.add_argument("--streamed", action="store_true", help="the table is kept by a stream")
    sub.add_argument("--n", type=int, default=ranking.DEFAULT_N)
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.action(spark or build_session(f"skyledger-{args.command}"), args)


if __name__ == "__main__":
    main()
