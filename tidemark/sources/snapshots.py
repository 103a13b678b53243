"""Tables partitioned by date, published whole.

A run writes the dates it replaces into a folder of its own, where no reader looks, and then publishes
them: a numbered snapshot names, for every table and date, the run whose folder holds it. A snapshot appears by
exclusive rename (see `sources.state`), so readers see the tables either before a run or after it, and of two
runs that began from one snapshot the later one is refused before anything of it can be seen.

Folders that the last `KEPT` snapshots don't name are dropped as new ones are published; until then a reader
may hold on to an older snapshot by its number.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scratch import folder_ages, partition_values, remove_folder
from tidemark.sources.state import RunState, Step

KEPT = 5  # snapshots behind the last one that stay readable

Places = dict[str, dict[str, str]]  # table -> ISO date -> run


class Snapshots:
    """The published versions of the tables in one folder; the table "" is that folder itself."""

    def __init__(self, spark: SparkSession, path: str, kept: int | None = None):
        self.spark = spark
        self.path = path
        self.kept = KEPT if kept is None else kept
        self.state = RunState(spark, f"{path}/_snapshots", self.kept)

    def begin(self) -> Snapshot:
        """The tables as they are now, and the right to publish the next snapshot."""
        return Snapshot(self, self.state.begin())

    def at(self, number: int) -> Snapshot:
        """An earlier snapshot, for reading; ValueError if it isn't kept any more. Number 0 has no rows."""
        return Snapshot(self, self.state.at(number))

    def folder(self, table: str) -> str:
        return f"{self.path}/{table}" if table else self.path

    def drop_abandoned(self, hours: float = 24) -> list[str]:
        """Remove the folders of runs that died before they published; returns their names.

        A run under way has no snapshot yet either: `hours` must be longer than any run takes.
        """
        named = {run for n in self.state.numbers() for dates in _places(self.state.at(n)).values() for run in dates.values()}
        tables = {table for n in self.state.numbers() for table in _places(self.state.at(n))}
        limit, gone = time.time() - hours * 3600, []
        for table in sorted(tables):
            for name, changed in folder_ages(self.spark, self.folder(table), "run").items():
                if name not in named and changed < limit:
                    remove_folder(self.spark, f"{self.folder(table)}/run={name}")
                    gone.append(name)
        return gone


class Snapshot:
    """One consistent version of the tables."""

    def __init__(self, snapshots: Snapshots, step: Step):
        self.snapshots = snapshots
        self._step = step
        self.places = _places(step)

    @property
    def number(self) -> int:
        return self._step.number

    def dates(self, table: str, since: dt.date | None = None) -> list[dt.date]:
        """Dates that hold rows, in order; known from the snapshot alone."""
        return [dt.date.fromisoformat(d) for d in sorted(self._places_from(table, since)) if d[0].isdigit()]

    def read(self, table: str, schema: str, since: dt.date | None = None) -> DataFrame:
        """A table under a fixed schema, with `run`. Only the folders of its dates from `since` on are listed."""
        spark, folder = self.snapshots.spark, self.snapshots.folder(table)
        runs: dict[str, list[str]] = {}
        for day, run in sorted(self._places_from(table, since).items()):
            runs.setdefault(run, []).append(day)
        if not runs:
            return spark.createDataFrame([], schema)
        found = [f"{folder}/run={run}/event_date={{{','.join(days)}}}" for run, days in runs.items()]
        return spark.read.schema(schema).option("basePath", folder).parquet(*found)

    def publish(
        self, runs: dict[str, str], since: dt.date | None = None, dates: Iterable[dt.date] | None = None
    ) -> Snapshot:
        """Make the folder of a run (table -> run) the new content of the tables, and return the new snapshot.

        The run takes the place of all dates from `since` on (of these the given `dates`), with or without
        rows, and of any other date it has rows for. Which dates these are is read from the names of its
        folders. ConflictingRunError if another run has published since this snapshot.
        """
        chosen = None if dates is None else {d.isoformat() for d in dates}
        after = dict(self.places)
        for table, run in runs.items():
            kept = {
                day: old for day, old in self.places.get(table, {}).items()
                if (since is not None and day < since.isoformat()) or (chosen is not None and day not in chosen)
            }
            fresh = partition_values(self.snapshots.spark, f"{self.snapshots.folder(table)}/run={run}", "event_date")
            after[table] = kept | {day: run for day in fresh}
        state = self.snapshots.state
        leaving = self.number - self.snapshots.kept
        lost = _folders(_places(state.at(leaving))) if leaving in state.numbers() else set()
        step = Step(state, self.number, dict(self._step.values))
        step.commit({table: json.dumps(places) for table, places in after.items()})
        self._drop(lost)
        return Snapshot(self.snapshots, step)

    def _places_from(self, table: str, since: dt.date | None) -> dict[str, str]:
        places = self.places.get(table, {})
        return places if since is None else {d: r for d, r in places.items() if d >= since.isoformat()}

    def _drop(self, lost: set[tuple[str, str, str]]) -> None:
        """Remove those of the folders that no snapshot names any more; whole runs where none of theirs is left."""
        state = self.snapshots.state
        named = set().union(*[_folders(_places(state.at(n))) for n in state.numbers()])
        used = {(table, run) for table, run, _ in named}
        for table, run, day in lost - named:
            folder = f"{self.snapshots.folder(table)}/run={run}"
            remove_folder(self.snapshots.spark, folder if (table, run) not in used else f"{folder}/event_date={day}")


def _places(step: Step) -> Places:
    return {table: json.loads(places) for table, places in step.values.items()}


def _folders(places: Places) -> set[tuple[str, str, str]]:
    return {(table, run, day) for table, days in places.items() for day, run in days.items()}
