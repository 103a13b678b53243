"""Schemas of the records themselves: what fields payloads have, and of what type."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FractionalType, IntegralType, NullType, StructType, VariantType

MIXED = "VARIANT"  # type of a field that came with types that don't go together
_PART = re.compile(r"`(?:[^`]|``)*`|OBJECT<")

Fields = dict[str, str]  # path -> type


def observe(raw: DataFrame, column: str = "payload") -> Fields:
    """Paths and types of all fields of a load.

    One aggregate, whose state is a schema: tasks combine their records' schemas, and one text comes to the
    driver, as when Spark infers the schema of files. Records that are no object (broken ones are
    null) have no fields.
    """
    objects = F.when(F.schema_of_variant(column).startswith("OBJECT"), F.col(column))
    found = raw.agg(F.schema_of_variant_agg(objects)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return {}
    # Spark's own name for an object that isn't within quotes, so that the type can be parsed.
    text = _PART.sub(lambda m: m[0] if m[0].startswith("`") else "STRUCT<", found)
    return dict(sorted(_flat("", DataType.fromDDL(text))))


def _flat(path: str, kind: DataType):
    if isinstance(kind, StructType):
        for field in kind.fields:
            yield from _flat(f"{path}[{_quoted(field.name)}]", field.dataType)
    elif isinstance(kind, ArrayType):
        yield from _flat(f"{path}[*]", kind.elementType)
    else:
        yield path, _name(kind)


def _quoted(name: str) -> str:
    return f'"{name}"' if "'" in name else f"'{name}'"


def _name(kind: DataType) -> str:
    if isinstance(kind, NullType):
        return "VOID"
    if isinstance(kind, IntegralType):
        return "BIGINT"
    if isinstance(kind, FractionalType):  # JSON has decimals of any precision
        return "DOUBLE"
    return MIXED if isinstance(kind, VariantType) else kind.simpleString().upper()


def merge(known: Mapping[str, str], seen: Mapping[str, str]) -> tuple[Fields, list[dict[str, str]]]:
    """Fields after a load that had `seen`, and the conflicts: path, known, seen.

    New fields are added and none goes. A null takes any type, whole numbers become DOUBLE beside
    fractions; other types that don't agree, and a field that is an object here and a value there, are conflicts, and
    the field is VARIANT from then on, which is no conflict with anything again.
    """
    fields, conflicts = dict(known), []
    for path, kind in seen.items():
        old = fields.get(path)
        if old in (None, kind, "VOID"):
            fields[path] = kind
        elif kind == "VOID" or old == MIXED:
            continue
        elif {old, kind} == {"BIGINT", "DOUBLE"}:
            fields[path] = "DOUBLE"
        else:
            fields[path] = MIXED
            conflicts.append({"path": path, "known": old, "seen": kind})
    for path in sorted(fields):
        inner = [p for p in fields if p.startswith(f"{path}[")]
        if inner and fields[path] not in ("VOID", MIXED):
            conflicts.append({"path": path, "known": fields[path], "seen": "OBJECT" if inner[0][len(path) + 1] != "*" else "ARRAY"})
            fields[path] = MIXED
    return dict(sorted(fields.items())), conflicts


def project(raw: DataFrame, fields: Mapping[str, str], column: str = "payload") -> DataFrame:
    """One typed column per field, named by its path without brackets; null where a record has another type.

    Elements of arrays, and fields of more than one type, stay in `column`, which is kept.
    """
    chosen = {path: kind for path, kind in fields.items() if "[*]" not in path and kind not in (MIXED, "VOID")}
    return raw.select(
        *[F.try_variant_get(column, f"${path}", kind).alias(label(path)) for path, kind in chosen.items()], column
    )


def label(path: str) -> str:
    """A path as people write it: names joined by dots."""
    return ".".join(part[0] or part[1] or "*" for part in re.findall(r"""\['([^']*)'\]|\["([^"]*)"\]|\[\*\]""", path))
