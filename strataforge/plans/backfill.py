"""Serial backfill of days."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

from ..functions.keys import run_key
from .store import Store


def days(first: date, last: date) -> Iterator[date]:
    while first <= last:
        yield first
        first += timedelta(days=1)


def status_of(store: Store, day: date, pipeline: str = "silver_behavioral") -> str | None:
    if not store.exists("pipeline_state"):
        return None
    row = store.read("pipeline_state").where(f"run_key = '{run_key(day, pipeline)}'").first()
    return row["status"] if row else None


def backfill(store: Store, first: date, last: date, run: Callable[[date], object], pipeline: str = "silver_behavioral", source_exists: Callable[[date], bool] | None = None) -> dict[date, str]:
    """Run each day once, in order. Days that succeeded are skipped, a running day stops the backfill, a failure too."""
    done: dict[date, str] = {}
    for day in days(first, last):
        status = status_of(store, day, pipeline)
        if status == "SUCCEEDED":
            done[day] = "skipped"
            continue
        if status == "RUNNING":
            raise RuntimeError(f"{day} is running")
        if source_exists is not None and not source_exists(day):
            done[day] = "no source"
            continue
        run(day)
        done[day] = "run"
    return done
