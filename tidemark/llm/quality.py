"""Quality rules: counts per document, perplexity bands per language by characters and by words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, store

ORDER = 4
CLASSES = 32  # so a language's model has at most 32^4 n-grams, whatever its texts
#: n-grams of the models that one pass holds in a worker: about 130 MB.
PASS_NGRAMS = 8_000_000
#: Languages that have full tables in a worker at most, each once it has scored so many characters: 8 MB each.
FULL_TABLES, FULL_AFTER = 6, 1_000_000
BIN = 1e-3  # nats; width of the bins that give the quartiles
WINDOW = 8
PIECE = 16  # characters that get one language where a document is fitted to several
#: Documents that speak for a language before passages in other documents are fitted to it.
LEAST_DOCS = 20
#: Occurrences of a context that give its own counts a quarter of the weight, half at most.
CONTEXT = 10.0
#: Bits of an n-gram's hash: at least so many, and at least so many more than number the corpus's characters.
#: Of a large corpus less than one n-gram in 1,000 shares its key; each bit is sent with each n-gram.
KEY_BITS, SPARE_BITS = 37, 7
#: Characters and texts of one block, which is held while its words are counted and while they are scored.
#: The larger, the fewer pairs are sent twice; a pair and its text must fit 63 bits.
BLOCK_CHARS = 22_000_000
BLOCK_TEXTS = 2**14
#: Characters of text in a partition of blocks.
SPREAD_CHARS = 8_000_000
#: Characters of text whose n-grams one group adds up.
RANGE_CHARS = 16_000_000

_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


# --- characters ---------------------------------------------------------------


def _class_of(point: int) -> int:
    """0 space, 1-26 letters without case or accents, 27 digit, 28 punctuation, 29 symbol, 30 other."""
    c = chr(point)
    if c.isspace():
        return 0
    base = unicodedata.normalize("NFD", c)[0].lower()
    if "a" <= base <= "z":
        return 1 + ord(base) - ord("a")
    if c.isdigit():
        return 27
    kind = unicodedata.category(c)
    return 28 if kind[0] == "P" and c not in "#*%&" else 29 if kind[0] in "SP" else 30


_TABLE: np.ndarray | None = None


def classes(text: str) -> np.ndarray:
    """Character class of every code point; letters of other scripts share classes by number."""
    global _TABLE
    if _TABLE is None:
        points = np.arange(0x110000)
        table = (1 + points % 26).astype(np.uint32)
        table[:0x250] = [_class_of(p) for p in range(0x250)]
        table[0x2000:0x2070] = [_class_of(p) for p in range(0x2000, 0x2070)]
        _TABLE = table
    return _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def ngrams(found: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each character, after three leading spaces.

    The hash is the classes as digits of base 32: different n-grams never collide.
    """
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint32), found])
    out = np.zeros(len(found), np.uint32)
    for k in range(order):
        start = ORDER - order + k
        out = out * np.uint32(CLASSES) + padded[start : start + len(found)]
    return out


# --- model --------------------------------------------------------------------


def count_ngrams(docs: DataFrame) -> DataFrame:
    """Counts of the longest n-grams over all documents: lang, hash, n.

    Each task adds up its rows per language before the shuffle.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                if lang not in totals:
                    if len(totals) == 16:  # bounds the worker's memory, not the languages
                        yield from rows(totals)
                        totals.clear()
                    totals[lang] = np.zeros(CLASSES**ORDER, np.int64)
                total = totals[lang]
                for text in texts:
                    seen, n = np.unique(ngrams(classes(text), ORDER), return_counts=True)
                    total[seen] += n
        yield from rows(totals)

    def rows(totals: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            if len(seen):
                yield pd.DataFrame({"lang": lang, "hash": seen, "n": total[seen]})

    return docs.mapInPandas(counts, "lang string, hash long, n long").groupBy("lang", "hash").agg(
        F.sum("n").alias("n")
    )


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (max(int((n == k).sum()), 1) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(d, 0.0, [0, 0.95, 1.9, 2.85])


Model = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def estimate(hashes: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated modified Kneser-Ney from the longest n-grams of one language.

    Returns for each order sorted n-gram hashes and their log probabilities, and sorted context
    hashes and the log weight that the lower order has after each. Lower orders count the
    different characters before an n-gram.
    """
    by_order = {ORDER: (hashes, counts)}
    for order in range(ORDER - 1, 0, -1):
        above = by_order[order + 1][0]
        by_order[order] = np.unique(above % CLASSES**order, return_counts=True)
    lower = np.full(CLASSES, 1.0 / CLASSES)  # of order 0: all classes alike
    model = []
    for order in range(1, ORDER + 1):
        grams, n = by_order[order]
        context = grams // CLASSES
        names, at = np.unique(context, return_inverse=True)
        total = np.bincount(at, n)
        d = _discounts(n)
        cut = d[np.minimum(n, 3)]
        spare = np.bincount(at, cut) / total
        if order == 1:
            below = lower[grams]
        else:
            hashes_below, logp_below = model[-1][:2]
            below = np.exp(logp_below[np.searchsorted(hashes_below, grams % CLASSES ** (order - 1))])
        logp = np.log((n - cut) / total[at] + spare[at] * below)
        if order == 1:  # every class has a probability, seen or not
            full = np.log(np.maximum(spare[0], 1e-9) * lower)
            full[grams] = logp
            grams, logp = np.arange(CLASSES), full
        model.append((grams.astype(np.uint32), logp, names.astype(np.uint32), np.log(np.maximum(spare, 1e-12))))
    return model


def gram_log_probabilities(longest: np.ndarray, model: Model) -> np.ndarray:
    """Log probability of the last character of each n-gram of the longest order, in nats."""
    logp = np.zeros(len(longest))
    left = np.arange(len(longest))  # n-grams that weren't found at a higher order
    for order in range(ORDER, 0, -1):
        grams = longest[left] % np.uint32(CLASSES**order)
        hashes, known, contexts, weights = model[order - 1]
        at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
        hit = hashes[at] == grams
        logp[left[hit]] += known[at[hit]]
        left = left[~hit]
        if not len(left) or order == 1:
            break
        before = grams[~hit] // np.uint32(CLASSES)
        at = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
        logp[left] += np.where(contexts[at] == before, weights[at], 0.0)
    return logp


def full_table(model: Model) -> np.ndarray:
    """The log probabilities of all n-grams there can be, seen or not."""
    return gram_log_probabilities(np.arange(CLASSES**ORDER, dtype=np.uint32), model)


class Models(dict):
    """Models by language. A worker keeps them, with the full tables of languages that it scores often."""

    def __init__(self, models: dict[str, Model]):
        super().__init__(models)
        self.scored: dict[str, int] = {}
        self.tables: dict[str, np.ndarray] = {}

    def of(self, lang: str, n_chars: int) -> Model | np.ndarray:
        """What scores the next characters of a language."""
        self.scored[lang] = self.scored.get(lang, 0) + n_chars
        if lang not in self.tables and self.scored[lang] > FULL_AFTER and len(self.tables) < FULL_TABLES:
            self.tables[lang] = full_table(self[lang])
        return self.tables.get(lang, self[lang])


def log_probabilities(found: np.ndarray, model: Model | np.ndarray) -> np.ndarray:
    """Log probability of every character, in nats, by a model or its full table."""
    longest = ngrams(found, ORDER)
    return model[longest] if isinstance(model, np.ndarray) else gram_log_probabilities(longest, model)


def log_perplexity(found: np.ndarray, model: Model | np.ndarray) -> float:
    """Mean negative log probability of the characters, in nats."""
    return -float(log_probabilities(found, model).mean())


def piece_costs(found: np.ndarray, model: Model) -> np.ndarray:
    """Negative log probability of each piece of `PIECE` characters, in nats."""
    return -np.add.reduceat(log_probabilities(found, model), np.arange(0, len(found), PIECE))


# --- words --------------------------------------------------------------------


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two numbers each."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by byte, without the bytes that are 0 in all, so that frequent bytes compress."""
    flat = np.ascontiguousarray(numbers)
    flat = flat.view(np.uint8).reshape(-1, flat.itemsize)
    there = [k for k in range(flat.shape[1]) if flat[:, k].any()]
    raw = pa.compress(np.concatenate([flat[:, k] for k in there]), codec="zstd", asbytes=True) if there else b""
    return len(flat).to_bytes(5) + sum(1 << k for k in there).to_bytes(1) + raw


def _unpacked(raw: bytes, kind: str = "<u8") -> np.ndarray:
    n = int.from_bytes(raw[:5])
    there = [k for k in range(8) if raw[5] >> k & 1]
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    if there:
        found = np.frombuffer(pa.decompress(raw[6:], n * len(there), codec="zstd"), np.uint8)
        for plane, k in zip(found.reshape(-1, n), there, strict=True):
            out[:, k] = plane
    return out.view(kind).ravel()


def _packed_ids(ids: np.ndarray, n: int) -> list[bytes]:
    """Numbers below n of which small ones are frequent: the four leading bits of each with the number of bits
    that are left, and these, first where few are left."""
    all_ids = np.arange(8, n + 8)
    power = np.frexp(all_ids.astype(float))[1] - 4
    lead = ((power << 3) + (all_ids >> power) - 8).astype("<u1")[ids]
    rest = (all_ids & ((1 << power) - 1)).astype("<u4")[ids]
    return [_packed(lead), _packed(rest[np.argsort(lead >> 3, kind="stable")])]


def _unpacked_ids(lead: bytes, rest: bytes) -> np.ndarray:
    lead = _unpacked(lead, "<u1")
    at = np.argsort(lead >> 3, kind="stable")
    ids = (((lead & 7) + 8).astype(np.int32) << (lead >> 3)) - 8
    ids[at] += _unpacked(rest, "<u4").astype(np.int32)
    return ids


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and word number of every word, A-Z in lower case, and the words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    doc, flat = pc.list_parent_indices(split), pc.list_flatten(split)
    there = pc.greater(pc.binary_length(flat), 0)  # none before a leading space or after the last one
    if not pc.all(there).as_py():
        doc, flat = doc.filter(there), flat.filter(there)
    coded = flat.dictionary_encode()
    return doc.to_numpy(), coded.indices.to_numpy(), coded.dictionary


def block_of(hashes: np.ndarray, texts: pa.Array, bits: int) -> dict:
    """Texts with their words as numbers, frequent words first, then by hash; texts without words go."""
    doc, word, names = words_of(texts)
    lengths = np.bincount(doc, minlength=len(hashes))
    named = pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False) >> np.uint64(64 - bits)
    often = np.frexp(np.bincount(word, minlength=len(named)))[1]
    order = np.lexsort((named, -often))
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    lead, rest = _packed_ids(number[word], len(number))
    hashes, lengths = hashes[lengths > 0], lengths[lengths > 0]
    return {
        "hashes": hashes.astype("<i8").tobytes(), "lengths": _packed(lengths),
        "names": _packed(np.diff(named[order], prepend=np.uint64(0))), "lead": lead, "rest": rest,
    }


def _starts(numbers: np.ndarray) -> np.ndarray:
    """Whether each of some sorted numbers differs from the one before."""
    return np.append(np.ones(min(len(numbers), 1), bool), numbers[1:] != numbers[:-1])


def _numbered(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers, sorted, and the place of each number there, in less memory than np.unique takes."""
    shift = len(numbers).bit_length()
    if len(numbers) and int(numbers.max()) >> (64 - shift) == 0:  # one sort of values, each with its place
        both = numbers.astype(np.uint64)
        both <<= np.uint64(shift)
        both |= np.arange(len(numbers), dtype=np.uint64)
        both.sort()
        order = (both & np.uint64((1 << shift) - 1)).astype(np.int32 if shift < 32 else np.int64)
        both >>= np.uint64(shift)
        numbers = both.astype(numbers.dtype, copy=False)
    else:
        order = np.argsort(numbers)
        numbers = numbers[order]
    starts = _starts(numbers)
    place = np.empty(len(numbers), np.int32)
    place[order] = np.cumsum(starts, dtype=np.int32) - 1
    return numbers[starts], place


class WordGrams:
    """Words and word pairs of a block.

    Grams are numbered: words, the start that stands before a text's first word, nothing, which stands
    before single words, then pairs. `keys` are their different hashes, sorted; `at` is a gram's place there.
    `doc`, `context`, `word` and `pair` tell every different pair of every text, sorted in this order;
    `times` is how often it stands there.
    """

    def __init__(self, row: dict, bits: int):
        self.hashes = np.frombuffer(row["hashes"], "<i8")
        self.lengths = _unpacked(row["lengths"]).astype(np.int64)
        names = np.cumsum(_unpacked(row["names"]), dtype=np.uint64)
        word = _unpacked_ids(row["lead"], row["rest"])
        self.n_words = n = len(names)
        context = np.roll(word, 1)
        context[np.cumsum(self.lengths) - self.lengths] = n
        # Sorted as one number each, and kept as short ones: a task's memory is what this takes.
        found = np.repeat(np.arange(len(self.lengths)), self.lengths)
        for size, part in ((n + 1, context), (n, word)):
            found *= size
            found += part
        del word, context, part
        found.sort()
        starts = _starts(found)
        self.times = np.diff(np.flatnonzero(starts), append=len(found)).astype(np.int32)
        found = found[starts]
        self.doc = (found // (n * (n + 1))).astype(np.int32)
        found %= n * (n + 1)
        self.context, self.word = ((found // n).astype(np.int32), (found % n).astype(np.int32))
        pairs, self.pair = _numbered(found)
        del found, starts
        named = np.append(names, np.array([1, 0], np.uint64))
        keys = np.append(named, _mixed(named[pairs // n], named[pairs % n]) >> np.uint64(64 - bits))
        del pairs
        self.keys, self.at = _numbered(keys)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """For each key the texts that hold it, and their different n-grams that follow on it."""
        n, n_texts = self.n_words, len(self.lengths)
        words = np.sort(self.word.astype(np.int64) * n_texts + self.doc)
        of_word = np.bincount(words[_starts(words)] // n_texts, minlength=n)
        del words
        texts = np.concatenate([of_word, [0, 0], np.bincount(self.pair)])
        after = np.append(np.bincount(self.context, minlength=n + 1), of_word.sum())
        # Exact: sums of whole numbers far below 2^53.
        return (
            np.bincount(self.at, texts, len(self.keys)).astype(np.int64),
            np.bincount(self.at[: n + 2], after, len(self.keys)).astype(np.int64),
        )

    def log_perplexity(self, texts: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Nats a word of each text, given the counts over all texts.

        A text's own part is taken out of the counts first, so an n-gram of no other text is unseen.
        """
        n, n_texts = self.n_words, len(self.lengths)
        total = np.zeros(n_texts)
        texts, after = texts[self.at], after[self.at[: n + 2]]  # by number of the gram
        # Some texts at a time, since there are many numbers per word.
        ends = np.searchsorted(self.doc, np.arange(0, n_texts, 500))
        for a, b in zip(ends, [*ends[1:], len(self.doc)], strict=True):
            doc, context, word = (x[a:b].astype(np.int64) for x in (self.doc, self.context, self.word))
            follow = doc * (n + 1) + context
            own = np.diff(np.flatnonzero(_starts(follow)), append=len(follow))
            own = np.repeat(own, own)
            own_words = np.bincount(np.unique(doc * n + word) // n, minlength=n_texts)
            below = (texts[word] - 0.5) / (after[n + 1] - own_words[doc] + 0.5)
            follow = after[context] - own
            weight = 0.5 / (follow + CONTEXT)  # times follow, by which the count would be divided
            below = weight * (texts[n + 2 + self.pair[a:b]] - 1) + (1 - weight * follow) * below
            total -= np.bincount(doc, np.log(below) * self.times[a:b], n_texts)
        return total / self.lengths


def word_perplexity(docs: DataFrame) -> DataFrame:
    """text_hash and word_perplexity, nats a word, of every different text with words.

    The model has all words and word pairs of all different texts, in every language, each
    counted once a text; a word's probability is half its share after its context, less for rare
    contexts, and the rest that without context; half a text is added for words, so that unseen ones have some.
    A text is scored without its own counts, as its words would foretell themselves.

    No worker holds the model: the texts that a task reads make blocks, in which words are numbers. A
    block sends its n-grams with its counts, a row per range of hashes; each range adds up what
    the blocks sent and answers in the order of the question. An n-gram is sent once a block, so
    frequent ones don't heap up. Texts themselves are not shuffled: only blocks, a quarter as long.
    """
    rows = docs.select("text_hash", "text").filter(F.col("text") != "")
    seen = store(rows.groupBy("text_hash").agg(F.count("*").alias("n"), F.min(F.length("text")).alias("chars")), "seen")
    chars = seen.agg(F.sum("chars")).first()[0] or 0
    # One of the copies of a text stays.
    copied = broadcast_if_small(seen.filter("n > 1").select("text_hash"))
    # Stored, so that a block has the same texts whenever it is made.
    once = store(rows.join(copied, "text_hash", "left_semi").dropDuplicates(["text_hash"]), "once")
    texts = rows.join(copied, "text_hash", "left_anti").unionByName(once)
    n_parts, n_ranges = 1 + chars // SPREAD_CHARS, 1 + chars // RANGE_CHARS
    bits = min(60, max(KEY_BITS, SPARE_BITS + int(chars).bit_length()))
    edges = np.array([(2**bits * k) // n_ranges for k in range(1, n_ranges)], np.uint64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.utf8_length(batch["text"]).to_numpy()
            # Blocks of one size, with room for a text more, so that no small one is left.
            most = min(BLOCK_CHARS, sizes.sum() // -(-max(sizes.sum(), 1) // BLOCK_CHARS) + sizes.max(initial=0))
            start = room = 0
            for k, size in enumerate([*sizes, None]):
                if k > start and (size is None or size > room or k == start + BLOCK_TEXTS):
                    part = batch.slice(start, k - start)
                    row = block_of(part["text_hash"].to_numpy(), part["text"], bits)
                    if row["hashes"]:
                        # A text stands in one block, so its hash can name it.
                        row["block"] = int(np.frombuffer(row["hashes"], "<i8")[0])
                        yield pa.RecordBatch.from_pylist([row], schema)
                    start, room = k, most
                room = (room if k > start else most) - (size or 0)

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        grams = WordGrams(row, bits)
        counts = grams.counts()
        out = []
        at = np.searchsorted(grams.keys, edges)
        for k, (a, b) in enumerate(zip([0, *at], [*at, len(grams.keys)], strict=True)):
            keys = _packed(np.diff(grams.keys[a:b], prepend=np.uint64(0)))
            out.append((row["block"], k, keys, *(_packed(c[a:b]) for c in counts)))
        return pd.DataFrame(out, columns=["block", "range", "keys", "texts", "after"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in rows.pop("keys")]
        ends = np.cumsum([len(x) for x in keys])[:-1]
        _, at = _numbered(np.concatenate(keys))
        for name in ("texts", "after"):
            sent = np.concatenate([_unpacked(x) for x in rows[name]])
            total = np.bincount(at, sent).astype(np.int64)[at] if len(at) else sent
            rows[name] = [_packed(x) for x in np.split(total, ends)]
        return rows

    def score(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("range")
        given = [np.concatenate([_unpacked(x).astype(np.int64) for x in answers[k]]) for k in ("texts", "after")]
        grams = WordGrams(rows.iloc[0], bits)
        return pd.DataFrame({"text_hash": grams.hashes, "word_perplexity": grams.log_perplexity(*given)})

    schema = pa.schema([("block", pa.int64()), *((k, pa.binary()) for k in ("hashes", "lengths", "names", "lead", "rest"))])
    kind = "block long, hashes binary, lengths binary, names binary, lead binary, rest binary"
    blocks = texts.select("text_hash", "text").mapInArrow(encode, kind).repartition(n_parts, "block")
    asked = blocks.groupBy("block").applyInPandas(ask, "block long, range int, keys binary, texts binary, after binary")
    answers = asked.repartition(n_parts, "range").groupBy("range").applyInPandas(
        answer, "block long, range int, texts binary, after binary"
    )
    return blocks.groupBy("block").cogroup(answers.repartition(n_parts, "block").groupBy("block")).applyInPandas(
        score, "text_hash long, word_perplexity double"
    )


# --- documents ----------------------------------------------------------------


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: exactly space and \x09-\x0D
    word_chars = len(raw.translate(None, _SPACE + _CONTINUATION))
    n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen: set[str] = set()
    n_dup_lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            n_dup_lines += line in seen
            seen.add(line)
    return len(words), word_chars, n_symbols, n_dup_lines, _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words that stand in an 8-word window found twice or more; windows by 64-bit hash."""
    n = len(words)
    if n <= WINDOW:
        return 0
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    rolling = hashed[: n - WINDOW + 1].copy()
    for k in range(1, WINDOW):
        rolling = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        rolling += hashed[k : n - WINDOW + 1 + k]
    _, at, times = np.unique(rolling, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[at] > 1)
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(docs: DataFrame, models: dict[str, list]) -> DataFrame:
    """Base counts and log perplexity of every row, one pass: doc_id, text_hash, lang, ...

    A text without characters, or in a language without a model, has no perplexity.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Models(models))

    def rows(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        names = [part.split()[0] for part in _MEASURES.split(", ")]
        out = pd.DataFrame([base_counts(t) for t in texts], columns=names)
        score = [
            log_perplexity(classes(t), shared.value.of(lang, len(t))) if t and lang in shared.value else None
            for t, lang in zip(texts, langs, strict=True)
        ]
        out["log_perplexity"] = pd.array(score, dtype="Float64")
        return out

    # Ids stay out of Python, whose frames would turn longs beside a null into doubles.
    found = F.pandas_udf(rows, f"{_MEASURES}, log_perplexity double")("text", "lang")
    return docs.select("doc_id", "text_hash", "lang", found.alias("found")).select("doc_id", "text_hash", "lang", "found.*")


def _models(counts: DataFrame, langs: list[str]) -> dict[str, list]:
    table = counts.filter(F.col("lang").isin(langs)).toPandas()
    models = {}
    for lang, rows in table.groupby("lang"):
        rows = rows.sort_values("hash")
        models[lang] = estimate(rows["hash"].to_numpy(), rows["n"].to_numpy())
    return models


def bands(scored: DataFrame, width: float, floor: float) -> DataFrame:
    """lang, lower, upper, middle, n: quartiles of the log perplexity, moved out by `width` times
    their distance. A language of n documents moves them by `floor` / sqrt(n) at least, as far as
    chance may move the quartiles of so few. Exact over fine bins, whose counts each task adds up
    before the shuffle, so reruns agree and no language's rows meet."""
    bins = (F.round(F.col("log_perplexity") / BIN) * BIN).alias("bin")
    quartile = [F.percentile("bin", q).alias(name) for q, name in ((0.25, "q1"), (0.75, "q3"))]
    out = F.greatest((F.col("q3") - F.col("q1")) * width, F.lit(floor) / F.sqrt("n"))
    return (
        scored.select("lang", bins).groupBy(F.col("lang").alias("band")).agg(*quartile, F.count("*").alias("n"))
        .select(
            "band", (F.col("q1") - out).alias("lower"), (F.col("q3") + out).alias("upper"),
            ((F.col("q1") + F.col("q3")) / 2).alias("middle"), "n",
        )
    )


def fit(above: DataFrame, counts: DataFrame, passes: list[list[str]], speak: dict[str, tuple]) -> DataFrame:
    """text_hash, lang and `fitted`: the log perplexity with every piece of a document under the
    language that fits it and its neighbours best, as far from its own language's middle as the
    pieces are from the middles of theirs. `above` has a row per text and language, `speak` the
    middle and the number of documents per language.

    Each pass holds the models of its languages, is stored, and frees them before the next one.
    """
    kind = "text_hash long, lang string, text string, best array<double>, moved array<double>"
    empty = F.array().cast("array<double>")
    so_far = above.select("text_hash", "lang", "text", empty.alias("best"), empty.alias("moved"))
    for langs in passes:
        shared = above.sparkSession.sparkContext.broadcast(_models(counts, [x for x in langs if x in speak]))

        def rows(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                best, moved = [], []
                for text, own, b, m in batch[["text", "lang", "best", "moved"]].itertuples(index=False):
                    found = classes(text)
                    length = np.diff([*range(0, len(found), PIECE), len(found)])
                    b, m = (np.array(x) if len(x) else np.full(len(length), np.inf) for x in (b, m))
                    for lang, model in shared.value.items():
                        if lang != own and speak[lang][1] < LEAST_DOCS:
                            continue
                        cost = piece_costs(found, model)
                        around = np.convolve(cost, np.ones(3))[1:-1]
                        better = around < b
                        b = np.where(better, around, b)
                        m = np.where(better, cost + length * (speak[own][0] - speak[lang][0]), m)
                    best.append(b)
                    moved.append(m)
                yield batch.assign(best=best, moved=moved)

        so_far = store(so_far.mapInPandas(rows, kind), "fitted")
        shared.destroy()
    total = F.aggregate("moved", F.lit(0.0), lambda x, y: x + y)
    return so_far.select("text_hash", "lang", (total / F.length("text")).alias("fitted"))


def judge(docs: DataFrame, width: float = 3.0, floor: float = 0.5, word_floor: float = 50.0) -> DataFrame:
    """Counts, base rules and perplexity band of every document; one row per row of `docs`.

    `docs` has doc_id, text, lang. base_failed: fewer than 20 words, or over 30 % of them in
    8-word windows that stand twice or more. kept: base rules hold and the log perplexity per
    character lies in its language's band (see `bands`). A passage in another language raises
    perplexity and is no fault: a document above the band is judged by `fitted` (see `fit`),
    for which each piece is scored under the language that fits it best, out of those with
    `LEAST_DOCS` documents and the document's own. So much for the spelling.

    Its words must hold too: `word_perplexity` is at most `word_upper`, the upper edge of the
    language's band of it. That model grows with the corpus and knows words and their order (see
    `word_perplexity`). A text below it is close to others, which is no fault here. Few documents
    say little about words, so there the edge is `word_floor` / sqrt(n) above the quartile at least.

    The model of spelling is modified Kneser-Ney of order 4 over 32 character classes, per
    language, counted by Spark over all documents; its size has a proven bound. Languages are
    scored in passes that hold at most `PASS_NGRAMS` n-grams, each over its own documents.

    A null text is empty and fails; a null language is one of its own; repeated rows each
    get a row; a table without rows gives none; other columns are not read.
    """
    docs = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"),
    )
    counts = store(count_ngrams(docs), "ngrams")
    sizes = counts.groupBy("lang").count().orderBy("lang").collect()  # a row per language
    passes: list[list[str]] = []
    room = 0
    for row in sizes:
        if row["count"] > room or not passes:
            passes.append([])
            room = PASS_NGRAMS
        passes[-1].append(row["lang"])
        room -= row["count"]
    none = docs.filter(~F.col("lang").isin([r["lang"] for r in sizes]))
    parts = [measure(docs.filter(F.col("lang").isin(langs)), _models(counts, langs)) for langs in passes]
    measured = reduce(DataFrame.unionByName, [*parts, measure(none, {})])
    few = F.col("n_words") < 20
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * 30
    words = store(word_perplexity(docs), "words").withColumnRenamed("text_hash", "of_text")
    measured = measured.join(broadcast_if_small(words), F.col("text_hash") == F.col("of_text"), "left").drop("of_text")
    measured = store(measured.withColumn("base_failed", few | repeats), "measured")
    scored = measured.filter(~F.col("base_failed") & F.col("log_perplexity").isNotNull())
    of_words = bands(scored.select("lang", F.col("word_perplexity").alias("log_perplexity")), width, word_floor)
    of_words = of_words.select(F.col("band").alias("word_band"), F.col("upper").alias("word_upper"))
    edges = bands(scored, width, floor).join(of_words, F.col("band") == F.col("word_band")).drop("word_band")
    edges = store(edges, "bands")
    key = ["text_hash", "lang"]
    high = store(
        scored.join(edges, F.col("lang") == F.col("band")).filter(F.col("log_perplexity") > F.col("upper"))
        .select(*[F.col(k).alias(f"high_{k}") for k in key]).distinct(),
        "high",
    )
    on = (F.col("text_hash") == F.col("high_text_hash")) & (F.col("lang") == F.col("high_lang"))
    above = docs.join(broadcast_if_small(high), on, "left_semi").dropDuplicates(key)
    speak = {r["band"]: (r["middle"], r["n"]) for r in edges.collect()}  # a row per language
    fitted = fit(above, counts, passes, speak)
    fitted = fitted.select(*[F.col(k).alias(f"high_{k}") for k in key], "fitted")
    inside = F.coalesce("fitted", "log_perplexity").between(F.col("lower"), F.col("upper"))
    inside &= F.col("word_perplexity") <= F.col("word_upper")
    return (
        measured.join(edges.drop("middle", "n"), F.col("lang") == F.col("band"), "left").drop("band")
        .join(broadcast_if_small(fitted), on, "left").drop(*[f"high_{k}" for k in key])
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
    )
