"""The registered queries against their SQL, and the pipeline against brute force, stage by stage."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import brute_components, brute_counts, brute_targets, mutated, prose, shingles, WORD
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF), duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = Counter(tuple(r) for r in got.select(columns).collect())
    assert rows == Counter(want.fetchall()) and rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    items = [(i, prose(500 + i, 20 + i)) for i in range(8)]
    rows = []
    for k in range(25):
        text = prose(k, 80 + 3 * k)
        rows += [text, text] + [mutated(text, 10 * k + j, j) for j in (1, 2, 9)]
    rows += [f"{prose(200 + i, 50)} {t} {prose(300 + i, 40)}" for i, t in items] + ["", "too short", None]
    rows += [" ".join("".join(random.Random(i).choices("qzxjkv", k=6)) for i in range(90))]
    docs = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(rows)] + [(None, prose(77, 60), None, None, None)]
    docs += [docs[0]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{root}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    labels = [(i, i % 2, 0) for i in range(0, 60, 3)] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    seen = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/stage-{len(seen)}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.collect())
    start, good, single, clean, mixed, sharded = seen
    names = start[0].asDict().keys()
    assert all(r.asDict().keys() == names for rows in seen[:5] for r in rows if rows)

    gone = Counter(start) - Counter(good)
    assert not Counter(good) - Counter(start)
    assert all(r in gone for r in start if brute_counts(r.text)[5])
    assert [r.doc_id for r in gone if not brute_counts(r.text)[5]] == [136]  # letters at random

    parts = brute_components([(r.doc_id, r.text) for r in good if r.doc_id is not None])
    assert sorted(r.doc_id for r in single if r.doc_id is not None) == sorted({c for _, c in parts.values()})

    def leaks(text):
        have = shingles(text)
        return any(5 * len(shingles(t) & have) >= 4 * len(shingles(t)) for t in items)

    assert Counter(clean) == Counter(r for r in single if not leaks(r.text))
    assert len(clean) < len(single)

    words = lambda t: len(WORD.findall(t or ""))
    sizes, taken, copies = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in clean:
        sizes[r.source] += words(r.text)
    for r in mixed:
        taken[r.source] += words(r.text)
        copies[r.doc_id].append(r.text)
    largest = max(words(r.text) for r in clean)
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= largest / 2 + 1
    text_of = {r.doc_id: r.text for r in clean}
    for i, texts in copies.items():
        assert len(texts) <= 2 and set(texts) == {text_of[i]}
    assert all(r.n_chars == len(r.text) for r in mixed)

    assert Counter((r.doc_id, r.text) for r in sharded) == Counter((r.doc_id, r.text) for r in mixed)
    slots = defaultdict(list)
    for r in sharded:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = corpus_pipeline.run(spark, folder).collect()
    assert Counter(again) == Counter(sharded)


def test_near_duplicates_of_repeated_ids(spark):
    """Rows that share an id are judged by their texts."""
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    near = mutated(a, 4, 1)
    rows = [
        (5, a), (5, a), (5, near), (7, near),  # one group, its smallest id on three rows
        (5, b), (6, b), (9, a),  # another text of that id; an id that is gone with one text ...
        (9, c),  # ... and stays with another
        (None, prose(4, 60)), (None, prose(5, 60)), (None, prose(4, 60)), (None, c),
        (3, ""), (3, ""), (3, None), (None, None),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    either = [t for t in (a, near) if (5, t) in got]
    assert len(either) == 1
    assert got == Counter([
        (5, either[0]), (5, b), (9, c), (None, prose(4, 60)), (None, prose(5, 60)), (3, ""), (3, ""), (3, None), (None, None),
    ])


CLASHING = ["id", "hash", "rows", "words", "all_taken", "share", "copies", "rest", "d", "h", "k1", "k2", "k3", "_hs",
            "_text_hash", "own_hash", "text_hash", "gone_id", "lower", "kept", "item", "part", "one"]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_columns_of_any_name(spark, folder, stage):
    """Rows are those of the plain table, and each keeps its values in columns that clash with helpers."""
    name, run = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60 or doc_id > 120 or doc_id is null")
    wide = docs.select("*", *[F.concat_ws(" ", F.lit(c), "doc_id").alias(c) for c in CLASHING])
    plain, got = run(spark, docs, folder).collect(), run(spark, wide, folder).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in plain) and got
    for r in got:
        own = "" if r.doc_id is None else f" {r.doc_id}"
        assert all(r[c] == f"{c}{own}" for c in CLASHING), name


def test_stages_with_ids_beyond_doubles(spark):
    """One null id in a batch doesn't change the others: the short text goes, and the near copy."""
    text = prose(70, 90)
    ids = [2**53 + 1, 2**53 + 3, None, 2**53 + 5]
    texts = [text, mutated(text, 1, 1), prose(71, 80), "too short"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in zip(ids, texts)], "doc_id long, text string, lang string").coalesce(1)
    good = corpus_pipeline.quality_rules(spark, docs, "")
    assert sorted(r.doc_id or 0 for r in good.collect()) == [0, ids[0], ids[1]]
    single = corpus_pipeline.near_duplicates(spark, good.coalesce(1), "")
    assert sorted(r.doc_id or 0 for r in single.collect()) == [0, ids[0]]


def test_mix_deals_whole_copies(spark, folder):
    """Rows that share an id and text in two sources, and repeated rows at the edge, lose no copy."""
    text = "one two three four five six seven\neight nine ten"
    rows = [(1, text, "a", 10, i) for i in range(7)] + [(1, text, "b", 10, i) for i in range(3)] + [(None, text, None, 10, 0)]
    rows += [(2, None, "a", 0, 0), (3, "", "b", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, number int")
    got = corpus_pipeline.source_mix(spark, docs, folder)
    assert got.columns == docs.columns
    found = defaultdict(Counter)
    for r in got.collect():
        assert r.text == text
        found[r.source][r.number] += 1
    want = brute_targets({"a": 70, "b": 30, None: 10})
    for source, target in want.items():
        assert sum(found[source].values()) * 10 - 5 <= target <= sum(found[source].values()) * 10 + 5
        dealt = found[source].values()
        assert max(dealt) <= 2 and (len(dealt) < {"a": 7, "b": 3, None: 1}[source] or max(dealt) - min(dealt) <= 1)
