"""Command line: the taking in of an extract, one routing run, the conveyor's answers, the
stream of run requests, the import of an existing state table, the removal of old snapshots, or
of a dead run's reservation."""

from __future__ import annotations

import argparse
from datetime import datetime
from functools import partial

from totelane import schemas
from totelane.operators.measures import take_in, taken_in
from totelane.plans.run import import_state, no_answers, record_answers, run_once
from totelane.session import build_session
from totelane.settings import PUTAWAY, SINGLE, RouterSettings
from totelane.sources import messages
from totelane.sources.jdbc import Database
from totelane.sources.state_store import StateStore
from totelane.sources.warehouse import Warehouse, canonical_state
from totelane.streaming.router import start_router


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--store", required=True, help="folder of the state snapshots")
    shared.add_argument("--states", nargs="+", choices=[SINGLE, PUTAWAY], default=[SINGLE])
    shared.add_argument("--random-mode", choices=["spread", "legacy"], default="spread")

    parser = argparse.ArgumentParser(prog="totelane", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", parents=[shared], help="plan and write the outbox")
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--extract", help="folder with one table per subfolder")
    source.add_argument("--database", help="JSON file with the tables of a database")
    run.add_argument("--canonical", action="store_true", help="the extract was taken in")
    run.add_argument("--out", required=True, help="folder for the tables of the run")
    run.add_argument("--conveyor", help="folder the messages are written to, once per run")

    ingest = commands.add_parser("ingest", help="take in an extract, with what is measured of it")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--extract", help="folder with one table per subfolder")
    source.add_argument("--database", help="JSON file with the tables of a database")
    ingest.add_argument("--out", required=True, help="folder of the canonical extract")
    ingest.add_argument("--append", action="store_true", help="add to what is there")

    answers = commands.add_parser("answers", parents=[shared], help="mark accepted routes")
    answers.add_argument("--acks", required=True, help="Parquet table id, tote_id, status")
    answers.add_argument("--run-folder", help="folder of the run that sent the messages")

    for command in (run, answers):
        command.add_argument("--run-id", required=True)
        command.add_argument("--as-of", required=True, type=datetime.fromisoformat)

    imported = commands.add_parser("import", parents=[shared], help="take over stored routes")
    source = imported.add_mutually_exclusive_group(required=True)
    source.add_argument("--state", help="Parquet table of stored routes")
    source.add_argument("--database", help="JSON file with the tables of a database")

    expired = commands.add_parser("expire", parents=[shared], help="remove old snapshots")
    expired.add_argument("--keep", type=int, required=True, help="snapshots that stay")

    released = commands.add_parser(
        "release", parents=[shared], help="give up the reservation of a run that died"
    )
    released.add_argument("--run-id", required=True)

    stream = commands.add_parser("stream", parents=[shared], help="follow run requests")
    stream.add_argument("--requests", required=True)
    stream.add_argument("--out", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", help="trigger interval; without it, work off and end")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session()
    if args.command == "ingest":
        read = Database.from_file(args.database).warehouse if args.database else None
        extract = read(spark) if read else Warehouse.read_extract(spark, args.extract)
        take_in(extract, args.out, args.append)
        print(f"taken in at {args.out}")
        return
    settings = RouterSettings(
        as_of=getattr(args, "as_of", datetime.min),
        states=tuple(args.states),
        random_mode=args.random_mode,
    )
    store = StateStore(spark, args.store)
    if args.command == "run":
        if args.database:
            warehouse = Database.from_file(args.database).warehouse(spark)
        elif args.canonical:
            warehouse = taken_in(spark, args.extract)
        else:
            warehouse = Warehouse.read_extract(spark, args.extract)
        deliver = no_answers
        if args.conveyor:
            deliver = partial(messages.send, path=args.conveyor, run=args.run_id)
        result = run_once(warehouse, store, settings, args.run_id, args.out, deliver)
        print(f"state version {result.version}, tables in {result.folder}")
    elif args.command == "answers":
        acks = spark.read.schema(schemas.ACKS).parquet(args.acks)
        version = record_answers(store, acks, settings, args.run_id, args.run_folder)
        print(f"state version {version}")
    elif args.command == "import":
        if args.database:
            state = Database.from_file(args.database).state(spark)
        else:
            state = canonical_state(spark.read.schema(schemas.TOTE_ROUTER).parquet(args.state))
        print(f"state version {import_state(store, state, settings)}")
    elif args.command == "expire":
        print(f"{store.expire(args.keep)} parts removed")
    elif args.command == "release":
        print("released" if store.release(args.run_id) else "the run holds no reservation")
    else:
        start_router(
            spark,
            args.requests,
            args.store,
            args.out,
            args.checkpoint,
            settings,
            no_answers,
            every=args.every,
        ).awaitTermination()


if __name__ == "__main__":
    main()
