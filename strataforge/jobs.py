"""The jobs as commands: ``python -m strataforge.jobs events --date 2024-01-31 --bronze ... --store ...``.

Every option has an environment variable (STRATAFORGE_ and its name in capitals); the command line wins.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .contracts import TABLES, ContractError
from .plans import backfill, gold, silver
from .plans.store import Store
from .session import build_session
from .sources import kafka_shape, partitions, registry
from .streaming import bronze, realtime

JOBS = ("bronze-events", "bronze-orders", "serve", "events", "orders", "events-wide", "orders-wide", "backfill-events")


@dataclass(frozen=True)
class Config:
    """What jobs need to know. ``servers`` or ``messages`` (a folder of records) and ``registry`` are for streams only."""

    bronze: str = ""
    store: str = ""
    serving: str = ""
    checkpoints: str = ""
    servers: str = ""
    messages: str = ""
    registry: str = ""
    events_topic: str = "behavioral.events"
    zone: str = "UTC"
    trigger: str = ""
    shuffle_partitions: int = 200
    dates_from: str = "2020-01-01"
    dates_to: str = "2035-12-31"

    @classmethod
    def of(cls, env: Mapping[str, str], given: Mapping[str, str | None] | None = None) -> Config:
        """From the environment and given options; a number that is none, or a missing half of a pair, raises."""
        found = {}
        for f in fields(cls):
            value = (given or {}).get(f.name) or env.get(f"STRATAFORGE_{f.name.upper()}")
            if value:
                try:
                    found[f.name] = int(value) if f.type == "int" else value
                except ValueError:
                    raise ContractError(f"{f.name} must be a whole number, not {value!r}") from None
        config = cls(**found)
        if config.shuffle_partitions < 1:
            raise ContractError("shuffle_partitions must be positive")
        if date.fromisoformat(config.dates_from) > date.fromisoformat(config.dates_to):
            raise ContractError("dates_from is after dates_to")
        return config

    def need(self, *names: str) -> None:
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ContractError(f"not configured: {', '.join(missing)}")


def _provider(config: Config) -> registry.SchemaProvider:
    return registry.HttpRegistry(config.registry) if config.registry.startswith("http") else registry.FileRegistry(config.registry)


def _topic(spark: SparkSession, config: Config, topic: str) -> DataFrame:
    return kafka_shape.read_topic(spark, topic, config.servers or None, config.messages or None)


def _streams(spark: SparkSession, config: Config, job: str) -> list[StreamingQuery]:
    """The running streams of a job, each with its own checkpoint."""
    config.need("checkpoints", "registry", "serving" if job == "serve" else "bronze")
    if not (config.servers or config.messages):
        raise ContractError("not configured: servers or messages")
    known, started, trigger = _provider(config), [], config.trigger or None
    topics = ({"behavioral": config.events_topic} if job != "bronze-orders" else {}) | ({t: t for t in TABLES} if job != "bronze-events" else {})
    for table, topic in topics.items():
        found, records, checkpoint = known.latest(f"{topic}-value"), _topic(spark, config, topic), f"{config.checkpoints}/{job}/{table}"
        if job == "serve":
            started.append(realtime.serve_messages(records, table, found.schema, found.schema_id, f"{config.serving}/{table}", checkpoint, trigger=trigger))
        elif table == "behavioral":
            rows = bronze.bronze_events(records, found.schema, found.schema_id, subject=f"{topic}-value")
            started.append(bronze.write_stream(rows, f"{config.bronze}/behavioral", checkpoint, ["year", "month", "day"], "bronze_behavioral", trigger))
        else:
            rows = bronze.bronze_transactional(records, table, found.schema, found.schema_id)
            started.append(bronze.write_stream(rows, f"{config.bronze}/{table}", checkpoint, ["partition_date"], f"bronze_{table}", trigger))
    return started


def run(spark: SparkSession, job: str, config: Config, day: date | None = None, last: date | None = None, now: datetime | None = None):
    """Run one job; days are those of the data. What the job's function returns is returned."""
    if job not in JOBS:
        raise ContractError(f"unknown job {job!r}")
    if job in ("bronze-events", "bronze-orders", "serve"):
        bronze.await_all(_streams(spark, config, job))
        return None
    if day is None:
        raise ContractError("this job needs a date")
    config.need("store")
    moment, store = now or datetime.now(timezone.utc).replace(tzinfo=None), Store(spark, config.store)
    if job == "events-wide":
        return gold.run_behavioral(store, day, moment)
    if job == "orders-wide":
        return gold.run_transactional(store, day)
    config.need("bronze")
    events_root = f"{config.bronze}/behavioral"
    users = lambda: store.read("dim_user") if store.exists("dim_user") else None
    one = lambda d: silver.run_events(store, partitions.read_events(spark, events_root, d, silver.run_key(d)), d, moment, users())
    if job == "events":
        return one(day)
    if job == "backfill-events":
        there = lambda d: partitions.exists(spark, f"{events_root}/year={d.year}/month={d.month}/day={d.day}")
        return backfill.backfill(store, day, last or day, one, source_exists=there)
    raw = {t: partitions.read_bronze(spark, config.bronze, t, f"{day:%Y%m%d}", config.zone) for t in TABLES}
    return silver.run_transactional(store, raw, moment, date.fromisoformat(config.dates_from), date.fromisoformat(config.dates_to))


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strataforge.jobs", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--date", type=date.fromisoformat, default=None, help="the day of the data; yesterday if a daily job gets none")
    parser.add_argument("--last", type=date.fromisoformat, default=None, help="the last day of a backfill")
    for f in fields(Config):
        parser.add_argument(f"--{f.name.replace('_', '-')}", dest=f.name, default=None)
    given = vars(parser.parse_args(argv))
    config = Config.of(os.environ, given)
    spark = build_session(f"strataforge-{given['job']}", spark__sql__shuffle__partitions=str(config.shuffle_partitions))
    try:
        print(run(spark, given["job"], config, given["date"] or date.today() - timedelta(days=1), given["last"]))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
