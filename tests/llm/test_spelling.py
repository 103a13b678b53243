"""Spelling variants against brute force, and the index's bound against all single edits."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES

LETTERS = "abcdeoéß"


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w, n in words.items():
        found = [o for o in words if near(w, o)]
        n_near[w] = len(found)
        if found:
            best = min(found, key=lambda o: (-words[o], o))
            if words[best] >= 10 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return Counter((w, form.get(w), root(w), n, n_near[w], words.get(form.get(w))) for w, n in words.items())


def edited(word, r):
    i, kind = r.randrange(len(word) + 1), r.randrange(3)
    if kind == 0:
        return word[:i] + r.choice(LETTERS) + word[i:]
    i = min(i, len(word) - 1)
    return word[:i] + word[i + 1 :] if kind == 1 else word[:i] + r.choice(LETTERS) + word[i + 1 :]


@pytest.fixture(scope="module")
def rows():
    """Words of few letters with chains of misspellings, cases, accents, other scripts; nulls and repeats."""
    r = random.Random(5)
    base = ["".join(r.choices(LETTERS, k=r.randint(6, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab"]
    out = []
    for i, word in enumerate(base):
        other = edited(word, r)
        third = edited(other, r)
        out += [(1000 * i + k, f"{word.upper()} {word}.{word}") for k in range(12 if i % 3 else 70)]
        out += [(1000 * i + 500 + k, f"{other},x{other}y {third}") for k in range(r.randint(1, 4))]
    out += [(90, 'baseword ' * 300), (91, 'bassword ' * 25), (92, 'bassworrd bassworrd')]
    out += [(None, base[0]), (None, base[0]), (None, None), (7, ""), (7, "1234567 ΔΔΔΔΔΔΔ"), out[3], out[3]]
    return out + [(9, "Ééß" * 500), (9, "Ééß" * 500), (8, "×÷abcde ×÷abcde")]


@pytest.mark.parametrize("list_length, most", [(2, 10**6), (20, 10**6), (2, 30), (1, 0)])
def test_variants(spark, rows, list_length, most):
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, word string")
    got = Counter(tuple(r) for r in spelling.variants(docs, list_length, most).collect())
    assert got == brute(rows)
    assert any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)


def test_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_variable_gram_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_one_edit_affects_no_more_grams_than_the_bound():
    """Every edit of a word leaves all grams but the bound's number, and one of the two that are merged."""
    r = random.Random(6)
    words = ["".join(r.choices("abc", k=r.randint(7, 11))) for _ in range(60)]
    counts = Counter(w[p : p + q] for w in words for q in (2, 3, 4) for p in range(len(w) - q + 1))
    frequent = {g: n for g, n in counts.items() if n > 8}
    for word in words:
        grams = spelling.decompose(word, frequent)
        bound = spelling.most_affected(grams)
        at = spelling.merged_pair(word, grams, frequent)
        pair = [next(g for g in grams if g[1] == at), next(g for g in grams if g[0] == at)]
        assert spelling.most_affected(pair) == 1
        n = len(word)
        others = {word[:i] + c + word[i:] for i in range(n + 1) for c in "abx"}
        others |= {word[:i] + word[i + 1 :] for i in range(n)} | {word[:i] + c + word[i + 1 :] for i in range(n) for c in "abx"}
        for other in others - {word}:
            if len(other) < 7:
                continue
            have = {(p, other[p:end]) for p, end, _ in spelling.decompose(other, frequent)}
            move = len(other) - n
            kept = sum((p, word[p:end]) in have or (p + move, word[p:end]) in have for p, end, _ in grams)
            assert kept >= len(grams) - bound
            assert word[:at] == other[:at] or word[at:] == other[at + move :]


def test_no_documents(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    short = spark.createDataFrame([(1, "too short to be"), (2, None)], "doc_id long, text string")
    assert spelling.variants(short).collect() == []
