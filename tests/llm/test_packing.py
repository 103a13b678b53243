"""Packing: ids against the tokenizer itself, places against the contract, bins against best fit and the bound."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import configurations, packing
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " \t\n", "don't 'ship' rock'n'roll we'll WE'LL 's '", "café café ́x naïve Ångströmª",
    "a<|endoftext|>b <|startoftext|>", "x" * 5000, "=" * 3000 + "'a", "1234 ²½ 3.14,15", "你好 世界 \U0001f600",
    "a b\u0085c\x0bd\x1ce", "İstanbul ΣΣ ǅ", "word " * 5000, "one", "one",
]


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def check_places(rows, capacity):
    """Gapless offsets in every sequence, none beyond the capacity."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(by) == list(range(len(by)))
    return len(by)


@pytest.mark.parametrize("seed", range(6))
def test_configurations_place_all_and_little_more_than_the_bound(seed):
    r = np.random.default_rng(seed)
    lengths = [
        r.integers(1, 101, 3000), r.integers(30, 60, 2000), np.repeat([51, 50, 34, 33, 17], [40, 60, 50, 90, 7]),
        r.integers(1, 101, 5), np.full(500, 40), r.integers(20, 45, 1500),
    ][seed]
    counts = counts_of(lengths, 100)
    chosen, least = configurations.pack(counts, 100)
    placed = np.zeros(101, int)
    for key, times in chosen.items():
        assert times > 0 and sum(k * v for k, v in key) <= 100
        for k, v in key:
            placed[k] += v * times
    assert (placed == counts).all()
    bins, plain = sum(chosen.values()), sum(configurations.best_fit(counts, 100).values())
    assert least <= bins <= plain + 1
    if seed in (0, 2, 3, 4):
        assert bins <= least * 1.03 + 1


def test_knapsack_against_all_multisets():
    r = np.random.default_rng(1)
    for _ in range(20):
        prices = np.where(r.random(13) < 0.6, r.random(13), 0.0)
        prices[0] = 0
        best, last = configurations.best_values(prices, 12)
        plain = [0.0]
        for size in range(1, 13):
            plain.append(max(plain[-1], *(prices[k] + plain[size - k] for k in range(1, size + 1))))
        assert np.allclose(best, plain)
        found = configurations._pattern(12, last)
        assert sum(k * v for k, v in found.items()) <= 12
        assert abs(sum(prices[k] * v for k, v in found.items()) - best[12]) < 1e-9


def test_no_pieces_and_full_pieces():
    assert configurations.pack(np.zeros(9, int), 8) == ({}, 0)
    assert configurations.pack(counts_of([8, 8, 8], 8), 8) == ({((8, 1),): 3}, 3)


def test_pieces_hold_the_tokenizers_ids(spark):
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pieces(docs, PATH, 64).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, low in enumerate(range(0, len(ids), 64)):
            part = ids[low : low + 64]
            want.append((i, k, low, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_ids_of_documents_are_kept_beside_null_ones(spark):
    ids = [2**53 + 1, 2**53 + 3, None, 2**53 + 5]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").coalesce(1)
    assert [r.doc_id for r in packing.pieces(docs, PATH).collect()] == ids


def test_words_of_all_latin_letters():
    """Word by word as the tokenizer does it, in either case, with marks and letters that have no case."""
    letters = [chr(c) for c in range(0x21, 0x100)]
    texts = [" ".join(f"{a}{b}{m}" for b in letters[::7] for m in ("", ".", "!", "..")) for a in letters]
    encode, tokenizer = packing._Encoder(PATH), Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode(texts) == want


def test_runs_of_marks_behind_words():
    """Ids are the tokenizer's, and a run of marks is encoded once for all words before it."""
    encode, tokenizer = packing._Encoder(PATH), Tokenizer.from_file(PATH)
    runs = ["$$$", ".%%%", "!!", "'s", "'", "-", "-x", ".'", "<|", "|>"]
    texts = [f"{word}{run} {word}" for run in runs for word in ("the", "ab", "était", "ß")]
    assert encode(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    whole: list[str] = []
    encode._encode = lambda texts: whole.extend(texts) or packing._Encoder._encode(encode, texts)
    encode(["one### two### three### one###"])
    assert whole == ["###"]


def test_cache_may_be_cleared_at_any_batch(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    encode = packing._Encoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for texts in (["a b c", "d e f g"], ["a b x"], ["g h"]):
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encode(texts) == want


def test_rows_of_one_length_are_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_GROUP", 4)
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20 + 1).cast("long").alias("length"),
        F.lit("own").alias("offset"), F.lit(1).alias("rank"),
    )
    got = packing.place(rows, 20).collect()
    assert len({r.doc_id for r in got}) == 3000 and all(r.rank == 1 for r in got)
    counts = counts_of([r.length for r in got], 20)
    assert check_places(got, 20) == sum(configurations.pack(counts, 20)[0].values())


def test_query_and_sequences(spark, tmp_path):
    texts = ODD + ["word " * k for k in range(200)] + ["same text"] * 100
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_configuration_packing"](spark, str(tmp_path)).collect()
    total = sum(r.length for r in got)
    assert check_places(got, 2048) <= -(-total // 2048) + 1
    assert got[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}

    placed = packing.place(packing.pieces(docs, PATH, 256), 256)
    whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    assert sum(r.n_tokens for r in whole.values()) == total
    for r in placed.collect():
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.place(packing.pieces(docs, PATH)).collect() == []
