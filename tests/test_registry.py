"""Schemas observed in payloads, and their numbered versions."""

import pytest

from tidemark.operators.registry import label, merge, observe, project
from tidemark.plans.paths import Paths
from tidemark.plans.registry import history, latest, register
from tidemark.sources.raw import from_text
from tidemark.sources.state import ConflictingRunError, Step


def raw(spark, *records):
    return from_text(spark.createDataFrame([(r,) for r in records], "value string"))


def test_fields_of_a_load(spark):
    seen = observe(raw(
        spark, '{"a": 1, "b": {"c": "x", "d": [1, 2.5]}, "n": null}', '{"a": 2, "t": true, "b": {"e": {}}}', "{broken", "17", '"text"',
    ))
    assert {label(p): t for p, t in seen.items()} == {"a": "BIGINT", "b.c": "STRING", "b.d.*": "DOUBLE", "n": "VOID", "t": "BOOLEAN"}


@pytest.mark.parametrize("records", [(), ("{broken",), ("17",), ("{}",), (None,)])
def test_a_load_without_fields(spark, records):
    assert observe(raw(spark, *records)) == {}


def test_names_that_need_quotes(spark):
    load = raw(spark, '{"a b": 1, "x.y": {"OBJECT<": "z"}, "it\'s": 2.5, "tick`s": true}')
    seen = observe(load)
    assert {label(p): t for p, t in seen.items()} == {"a b": "BIGINT", "x.y.OBJECT<": "STRING", "it's": "DOUBLE", "tick`s": "BOOLEAN"}
    got = project(load, seen).first()
    assert [got[i] for i in range(4)] == [1, 2.5, True, "z"] or {got[i] for i in range(4)} == {1, 2.5, True, "z"}


def test_types_that_differ_within_a_load(spark):
    assert observe(raw(spark, '{"a": 1}', '{"a": "x"}')) == {"['a']": "VARIANT"}


def test_merging():
    known = {"['a']": "BIGINT", "['b']": "STRING", "['c']": "VOID", "['d']": "VARIANT", "['e']": "BOOLEAN"}
    seen = {"['a']": "DOUBLE", "['b']": "BIGINT", "['c']": "STRING", "['d']": "STRING", "['e']": "VOID", "['f']": "STRING"}
    fields, conflicts = merge(known, seen)
    assert fields == {
        "['a']": "DOUBLE", "['b']": "VARIANT", "['c']": "STRING", "['d']": "VARIANT", "['e']": "BOOLEAN", "['f']": "STRING",
    }
    assert conflicts == [{"path": "['b']", "known": "STRING", "seen": "BIGINT"}]
    assert merge(fields, seen) == (fields, [])
    # A value that becomes an object or a list.
    fields, conflicts = merge({"['a']": "STRING", "['b']": "BIGINT"}, {"['a']['x']": "STRING", "['b'][*]": "BIGINT"})
    assert (fields["['a']"], fields["['b']"]) == ("VARIANT", "VARIANT")
    assert [(c["path"], c["seen"]) for c in conflicts] == [("['a']", "OBJECT"), ("['b']", "ARRAY")]


def test_versions(spark, tmp_path):
    paths = Paths(str(tmp_path))
    assert latest(spark, paths).number == 0 and history(spark, paths).isEmpty()
    first, second = raw(spark, '{"a": 1, "b": "x"}'), raw(spark, '{"a": 1.5, "b": 2, "c": {"d": true}}')
    assert register(first, paths, "one").number == 1
    assert register(first, paths, "again").number == 1
    assert register(second, paths, "two").number == 2
    assert register(first, paths, "three").number == 2
    assert [tuple(r) for r in history(spark, paths).collect()] == [
        (1, "one", "a", "BIGINT", "added", None), (1, "one", "b", "STRING", "added", None),
        (2, "two", "a", "DOUBLE", "widened", "BIGINT"), (2, "two", "b", "VARIANT", "conflict", "STRING"),
        (2, "two", "c.d", "BOOLEAN", "added", None),
    ]
    got = project(first.unionByName(second), latest(spark, paths).fields).drop("payload").collect()
    assert sorted(map(tuple, got), key=str) == [(1.0, None), (1.5, True)]


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    commit, inner = Step.commit, []

    def beside(step, values):
        if not inner:
            inner.append(1)
            register(raw(spark, '{"b": 1}'), paths, "other")
        commit(step, values)

    monkeypatch.setattr(Step, "commit", beside)
    with pytest.raises(ConflictingRunError):
        register(raw(spark, '{"a": 1}'), paths, "one")
    assert {label(p) for p in register(raw(spark, '{"a": 1}'), paths, "one").fields} == {"a", "b"}
