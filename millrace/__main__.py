"""Run a program: ``python -m millrace large-deposits --servers host:9092``."""

from __future__ import annotations

import argparse

from .plans.ingest import ingest_writer
from .plans.programs import PROGRAMS, board_stream, board_writer, build_program, program_split, program_writer, weather_stream
from .plans.transit import TransitTopics
from .session import build_session
from .sources.increments import POLL_SECONDS
from .sources.topics import Broker
from .streaming.run import checkpoint_for, kept_split, replay_checkpoint, run_available, run_forever
from .streaming.sinks import console, print_rows

BOARD = "status-board"
INGEST = "table-ingest"


def main() -> None:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("program", choices=sorted([*PROGRAMS, BOARD, INGEST]))
    parser.add_argument("--servers", default="", help="broker addresses")
    parser.add_argument("--folder", default="", help="read and write topics as files in this folder instead")
    parser.add_argument("--topics", nargs="*", default=[], help="topic names to read in place of the usual ones")
    parser.add_argument("--out", default="", help="topic to publish to")
    parser.add_argument("--start", default="earliest", choices=["earliest", "latest"])
    parser.add_argument("--max-records", type=int, help="records per micro-batch")
    parser.add_argument("--every", help="time between micro-batches, such as '60 seconds'")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    parser.add_argument("--checkpoint", help="checkpoint folder; a new one replays from --start")
    parser.add_argument("--space", default="", help="name space of the transit topics, such as org.example.")
    parser.add_argument("--json", action="store_true", help="transit topics hold JSON instead of Avro")
    parser.add_argument("--split", type=int, help="groups that each key of a join is spread over")
    parser.add_argument("--hot-share", type=float, help="spread only keys with more than this share of the records that are there at the first start")
    parser.add_argument("--watermark", help="drop window state so long behind the newest event, such as '1 hour'")
    parser.add_argument("--delay", help="how late a record of a bounded join may come, such as '10 minutes'")
    parser.add_argument("--within", help="how far apart the records of a bounded join may be, such as '30 days'")
    parser.add_argument("--replay", action="store_true", help="start again from --start with a new checkpoint")
    parser.add_argument("--table", default="", help="table to ingest")
    parser.add_argument("--column", default="", help="its growing key column")
    parser.add_argument("--source", default="", help="folder with the table as parquet")
    parser.add_argument("--jdbc", default="", help="database with the table, as a JDBC address")
    parser.add_argument("--allow", nargs="*", default=[], help="tables that may be read from the database")
    parser.add_argument("--prefix", default="connect-", help="topic name before the table's name")
    parser.add_argument("--seconds", type=int, default=POLL_SECONDS, help="time between two reads of the table")
    args = parser.parse_args()
    if bool(args.servers) == bool(args.folder):
        parser.error("give either --servers or --folder")

    spark = build_session(args.program)
    spark.sparkContext.setLogLevel("WARN")
    broker = Broker(args.servers, args.folder)
    checkpoint = args.checkpoint or (replay_checkpoint if args.replay else checkpoint_for)(spark, args.program)
    reading = {"start": args.start, "max_records": args.max_records}
    if args.program == INGEST:
        writer = ingest_writer(spark, args.table, args.column, broker, args.prefix, checkpoint, path=args.source, url=args.jdbc,
                               allowed=args.allow, seconds=args.seconds)
    elif args.program == BOARD:
        names = TransitTopics(args.space)
        # The board is in the checkpoint's state: a replay from a new one starts an empty board.
        writer = board_writer(board_stream(spark, broker, names, not args.json, **reading), checkpoint, print_rows)
        weather = console(weather_stream(spark, broker, names, not args.json, **reading), "update") \
            .option("checkpointLocation", f"{checkpoint}-weather")
        if args.once:
            run_available(weather, f"{BOARD}-weather")
        else:
            weather.queryName(f"{BOARD}-weather").start()
    else:
        options = {"split": args.split, "watermark": args.watermark, "delay": args.delay, "within": args.within,
                   "avro": False if args.json else None}
        options = {name: value for name, value in options.items() if value is not None}
        if args.hot_share:
            options["split"] = kept_split(spark, checkpoint, lambda: program_split(spark, args.program, broker, args.topics, args.hot_share))
        result = build_program(spark, args.program, broker, args.topics, space=args.space, options=options, **reading)
        writer = program_writer(result, args.program, broker, checkpoint, args.out, args.space, options)
    if args.once:
        run_available(writer, args.program)
    else:
        run_forever(writer, args.program, args.every)


if __name__ == "__main__":
    main()
