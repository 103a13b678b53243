"""Numbered versions of the schema that records have had, kept with the tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.registry import Fields, label, merge, observe
from tidemark.plans.paths import Paths
from tidemark.sources.state import RunState, Step

_ALL = 1_000_000  # versions; a schema changes when an application does


@dataclass(frozen=True)
class Version:
    """All fields known after `load`, and those whose types in that load didn't fit the ones known before."""

    number: int
    load: str
    fields: Fields
    conflicts: list[dict[str, str]]


def _state(spark: SparkSession, paths: Paths) -> RunState:
    return RunState(spark, paths.schemas, _ALL)


def _version(step: Step) -> Version:
    values = step.values
    return Version(
        step.number, values.get("load", ""), json.loads(values.get("fields", "{}")), json.loads(values.get("conflicts", "[]"))
    )


def latest(spark: SparkSession, paths: Paths) -> Version:
    """The newest version; number 0 without fields before the first load."""
    return _version(_state(spark, paths).begin())


def register(raw: DataFrame, paths: Paths, load: str) -> Version:
    """Compare the fields of a load with the newest version, and save a new one if they add to it.

    A load that brings nothing new, a repeated one too, leaves the registry as it is. Of two loads that
    register at once one is refused with ConflictingRunError and has only to be registered again.
    """
    step = _state(raw.sparkSession, paths).begin()
    known = _version(step)
    fields, conflicts = merge(known.fields, observe(raw))
    if fields != known.fields:
        step.commit({"load": load, "fields": json.dumps(fields), "conflicts": json.dumps(conflicts)})
    return _version(step)


def history(spark: SparkSession, paths: Paths) -> DataFrame:
    """What each version brought: version, load, path, type, change (added, widened or conflict) and the type before."""
    state = _state(spark, paths)
    rows, before = [], {}
    for number in sorted(state.numbers()):
        version = _version(state.at(number))
        clash = {c["path"]: c["known"] for c in version.conflicts}
        for path, kind in version.fields.items():
            old = before.get(path)
            if old != kind:
                change = "conflict" if path in clash else "added" if old is None else "widened"
                rows.append((number, version.load, label(path), kind, change, clash.get(path, old)))
        before = version.fields
    schema = "version int, load string, path string, type string, change string, type_before string"
    return spark.createDataFrame(rows, schema).orderBy(F.col("version"), F.col("path"))
