"""Spelling variants: words one edit apart, found through an index of variable-length grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, store

RUN = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2  # occurrences of a word
RATIO = 10  # how much more frequent a word's form is
SLIP = 31  # one run in so many loses a code point
SHORTEST, LONGEST = 2, 4  # code points of a gram
REACH = 2  # places from a word's middle where its two merged lists may meet
#: Starts with a gram that make the dictionary go on to longer ones; more where MOST_GRAMS would be passed.
LIST_LENGTH = 50
MOST_GRAMS = 300_000  # what the driver and a worker hold of the dictionary, about 40 MB


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and run of every maximal run of letters that can become a word, A-Z in lower case."""
    long_runs = F.regexp_extract_all("text", F.lit(f"{RUN}{{{MIN_LENGTH},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(long_runs).alias("run"))
    plain = F.octet_length("run") == F.char_length("run")  # then lower() changes A-Z only
    return found.withColumn("run", F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run"))))


def slipped(found: DataFrame) -> DataFrame:
    """`word` of every run: the run itself, or with one code point less where a hash says so."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    place = (h % F.char_length("run")).cast("int")
    shorter = F.concat(F.expr("substring(run, 1, _place)"), F.expr("substring(run, _place + 2)"))
    return (
        found.withColumn("_h", h).withColumn("_place", place)
        .select(F.when(F.col("_h") % SLIP == 0, shorter).otherwise(F.col("run")).alias("word"))
    )


def word_counts(words: DataFrame) -> DataFrame:
    """word and n of the words that are long and frequent enough."""
    return (
        words.filter(F.char_length("word") >= MIN_LENGTH)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)
    )


def _starts(word: str, lengths: range) -> Column:
    """All grams of the given lengths in a word, as an array."""

    def of_length(q: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.char_length(word) - q + 1, F.lit(1)))
        grams = F.transform(places, lambda p: F.substring(F.col(word), p, q))
        return F.when(F.char_length(word) >= q, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_length(q) for q in lengths])


def _bounded(counted: DataFrame, most: int) -> DataFrame:
    """The most frequent grams, all of a frequency or none, at most `most`."""
    if counted.count() <= most:
        return counted
    by_size = counted.groupBy("n").agg(F.count("*").alias("grams"))  # a row a frequency
    ranked = by_size.withColumn("all", F.sum("grams").over(W.orderBy(F.desc("n"))))
    least = ranked.filter(F.col("all") <= most).agg(F.min("n")).first()[0]
    return counted.filter(F.col("n") >= least) if least is not None else counted.limit(0)


def gram_dictionary(words: DataFrame, list_length: int = LIST_LENGTH, most_grams: int = MOST_GRAMS) -> dict[str, int]:
    """Grams of SHORTEST to LONGEST code points that more than `list_length` starts in words have, with that number.

    This is the trie of grams without its rare branches: a gram in it goes on to longer ones, one outside
    is long enough. Where more than `most_grams` have as many, a higher bound holds, so the driver
    and the workers take a bounded table whatever the vocabulary; the result is the same.
    """
    grams = words.select(F.explode(_starts("word", range(SHORTEST, LONGEST + 1))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > list_length)
    table = _bounded(store(counted, "grams"), most_grams).toArrow()
    return dict(zip(table["gram"].to_pylist(), table["n"].to_pylist(), strict=True))


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, int, int]]:
    """Of every start of a word its place, the end of its gram and the end of what was looked at.

    A gram grows from its start while it is in the dictionary. Which gram it becomes depends on the code points
    looked at only, and on the word's end if the gram still grew there.
    """
    n, out = len(word), []
    for p in range(n - SHORTEST + 1):
        end = p + SHORTEST
        while end < n and end - p < LONGEST and word[p:end] in frequent:
            end += 1
        out.append((p, end, end + (end == n and end - p < LONGEST and word[p:end] in frequent)))
    return out


def most_affected(grams: list[tuple[int, int, int]]) -> int:
    """How many of some grams of a word one edit can affect: the most that look at one place.

    An edit elsewhere leaves a gram as it is, at its place or moved by one.
    """
    return max((sum(p <= at < seen for p, _, seen in grams) for at, _, _ in grams), default=0)


def _rarity(part: str, frequent: dict[str, int]) -> float:
    """Roughly the logarithm of how many words have this part at one end, from the grams in it."""
    total = math.log(frequent.get(part[:LONGEST], 1))
    for i in range(1, len(part) - LONGEST + 1):
        total += math.log(frequent.get(part[i : i + LONGEST], 1) / frequent.get(part[i : i + LONGEST - 1], 1))
    return total


def merged_pair(word: str, grams: list[tuple[int, int, int]], frequent: dict[str, int]) -> int:
    """Where two grams of a word meet whose lists find all words one edit away.

    Of grams that one edit affects at most b of, any b + 1 will do, as a near word shares one. Two
    grams of which one looks no further than where the other starts have b = 1, and lists are shortest in
    sum if they meet where neither side is common. There is such a pair within REACH of the middle, as
    ends of grams rise by less than 2 * REACH + 1 from one start to the next.
    """
    n = len(word)
    meets = {seen for _, end, seen in grams if seen == end and abs(2 * end - n) <= 2 * REACH and end <= n - SHORTEST}
    return min(meets, key=lambda at: (
        math.exp(_rarity(word[:at], frequent)) + math.exp(_rarity(word[at:], frequent)), at
    ))


def _letters(word: str) -> int:
    """Two bits for each of 32 classes of letters: one if it occurs, one if it occurs again.

    One edit changes at most two of them.
    """
    bits = 0
    for c in word:
        one = 1 << 2 * (ord(c) % 32)
        bits |= one << 1 if bits & one else one
    return bits - 2**64 if bits >= 2**63 else bits


def near_pairs(words: DataFrame, list_length: int = LIST_LENGTH, most_grams: int = MOST_GRAMS) -> DataFrame:
    """word, n, other, other_n: each unordered pair of words exactly one edit apart, once.

    `words` have at least MIN_LENGTH code points. A gram's list is parted by the length of the word and by what stands on
    one side of the gram: one edit leaves either the gram and all before it, or the gram and all behind it,
    if it doesn't affect the gram. A word is held in the lists of all its grams that another may choose, and
    probes the two that `merged_pair` names, with its own length and one more. What meets there differs in few
    letters before edit distance verifies it.
    """
    frequent = gram_dictionary(words, list_length, most_grams)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, tails, sizes, letters = [], [], [], [], []

            def put(row: int, part: str, tail: bool, size: int, bits: int) -> None:
                rows.append(row)
                parts.append(part)
                tails.append(tail)
                sizes.append(size)
                letters.append(bits)

            for i, word in enumerate(batch.column(0).to_pylist()):
                n, bits, grams = len(word), _letters(word), decompose(word, frequent)
                for at in {end for _, end, seen in grams if seen == end and abs(2 * end - n) <= 2 * REACH + 1}:
                    put(i, word[:at], False, n, bits)
                for at, _, _ in grams:
                    if abs(2 * at - n) <= 2 * REACH + 1:
                        put(i, word[at:], True, n, bits)
                at = merged_pair(word, grams, frequent)
                for size in (n, n + 1):
                    put(i, word[:at], False, -size, bits)
                    put(i, word[at:], True, -size, bits)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(parts, pa.string()), pa.array(tails, pa.bool_()),
                 pa.array(sizes, pa.int32()), pa.array(letters, pa.int64())],
                ["word", "n", "part", "tail", "size", "letters"],
            )

    entries = store(
        words.select("word", "n")
        .mapInArrow(lists, "word string, n long, part string, tail boolean, size int, letters long")
        .select("word", "n", "letters", F.xxhash64("part", "tail", F.abs("size")).alias("list"), (F.col("size") < 0).alias("probes")),
        "lists",
    )
    held = entries.filter("not probes").select("list", *[F.col(c).alias(f"other_{c}") for c in ("word", "n", "letters")])
    # Of two words of one length the first in order probes.
    once = (F.char_length("word") < F.char_length("other_word")) | (F.col("word") < F.col("other_word"))
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2
    met = entries.filter("probes").join(held, "list").filter(alike & once & (F.levenshtein("word", "other_word", 1) == 1))
    return met.groupBy("word", F.col("other_word").alias("other")).agg(
        F.first("n").alias("n"), F.first("other_n").alias("other_n")
    )


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, form, form_n, n_near: a word's most frequent near word, if RATIO times as frequent.

    Ties go to the smallest in code-point order; n_near counts all near words.
    """
    both = pairs.select("word", "other", "other_n").unionByName(
        pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    joined = words.join(best, "word", "left")
    found = -F.col("best.less") >= RATIO * F.col("n")
    return joined.select(
        "word", "n", F.when(found, F.col("best.other")).alias("form"), F.when(found, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def roots(table: DataFrame) -> DataFrame:
    """`table` with root: the last word that following forms leads to.

    Counts grow RATIO times a step, so a chain is short and has no cycle; each round doubles the
    steps taken, over the words with a form only.
    """
    links = store(table.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = store(
            links.join(further, F.col("root") == F.col("via"), "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return table.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, list_length: int = LIST_LENGTH, most_grams: int = MOST_GRAMS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Runs of letters (RUN) count once per occurrence; rows that are repeated count again. A null text has no runs, a null
    doc_id enters the hash of a run as no characters. Columns other than doc_id and text aren't used; without words
    there are no rows. Equal counts are settled by code-point order.
    """
    words = store(word_counts(slipped(runs(docs))), "words")
    pairs = store(near_pairs(words, list_length, most_grams), "pairs")
    table = store(forms(words, pairs), "forms")
    return roots(table).select("word", "form", "root", "n", "n_near", "form_n")


