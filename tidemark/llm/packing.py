"""Best-fit packing of token sequences by the configuration linear program."""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.llm.configurations import pack as pack_histogram

CAPACITY = 2048
END = 0  # the id behind every document
CACHED_WORDS = 1_500_000  # kept by a Python worker between batches, about 300 MB
CHUNK_CHARS = 1 << 20  # text whose words are looked up together
#: Rows whose rank within their length is counted in one group; more where a corpus would need
#: over a million groups.
ROWS_PER_GROUP = 256
MOST_GROUPS = 1_000_000

_PIECE = "piece int, start long, length long, ids_crc32 long"

#: What may follow a word as a piece of its own; an apostrophe may belong to the letters behind it.
_MARKS = string.punctuation.replace("'", "")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as the Latin-1 character of its number if that can be seen, the other
    bytes as the characters from 256 on, in their order."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTES = _byte_letters()


def _units(text: str) -> list[str] | None:
    """Parts between white space, which the tokenizer treats alike wherever they stand; None for a text to be
    encoded whole, as a special token in a text is recognised before it is split.

    Beyond Latin-1 the lower case of a letter may depend on what is around it, so only the tokenizer makes it there.
    """
    if "<|" in text:
        return None
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class _Encoder:
    """Ids of texts as little-endian bytes; each distinct part is tokenized once while it is cached."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.marks: dict[str, bytes] = {}  # runs of them
        self.cache: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _run(self, marks: str) -> bytes:
        found = self.marks.get(marks)
        if found is None:
            found = self.marks[marks] = self._encode([marks])[0]
        return found

    def _learn(self, missing: set[str]) -> None:
        """A lower-case word of Latin-1 letters is one piece that no step before the model changes but for writing its
        bytes as letters, and so is a run of marks behind it. All else goes through the whole tokenizer."""
        cache, others = self.cache, []
        for unit in missing:
            if unit and max(unit) <= "ÿ" and unit.islower():
                stem = unit.rstrip(_MARKS)
                if stem.isalpha():
                    ids = cache.get(stem)
                    if ids is None:
                        ids = cache[stem] = self._word(stem)
                    if len(stem) < len(unit):
                        cache[unit] = ids + self._run(unit[len(stem):])
                    continue
            others.append(unit)
        cache.update(zip(others, self._encode(others), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
            self.marks.clear()
        split = [_units(t) for t in texts]
        found = [u and list(map(self.cache.get, u)) for u in split]
        missing: set[str] = set()
        for units, ids in zip(split, found, strict=True):
            if ids and None in ids:
                missing.update(compress(units, map(is_, ids, repeat(None))))
        self._learn(missing)
        out = []
        for text, units, ids in zip(texts, split, found, strict=True):
            if units is None:
                out.append(self._encode([text])[0])
                continue
            if None in ids:
                ids = [self.cache[u] if i is None else i for u, i in zip(units, ids, strict=True)]
            out.append(b"".join(ids))
        return out


_encoders: dict[str, _Encoder] = {}


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text or "")
        size += len(chunk[-1])
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece of every text.

    A document's ids are its text's, without special tokens added, and END; a null text counts as empty. Only a
    document of more than `capacity` ids is cut, into pieces of that many; the last may be shorter.
    doc_id may be null or repeated, a repeated row gives its pieces again; other columns are left out.
    `tokenizer_path` names a file that every executor has.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.setdefault(tokenizer_path, None) or _Encoder(tokenizer_path)
        _encoders[tokenizer_path] = encode
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1).to_pylist(), 0
            for chunk in _chunks(texts):
                rows, piece, start, length, crc, parts = [], [], [], [], [], []
                for row, own in enumerate(encode(chunk), at):
                    own += end
                    for i, low in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[low : low + 4 * capacity]
                        rows.append(row)
                        piece.append(i)
                        start.append(low // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            parts.append(part)
                at += len(chunk)
                out = [ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
                out += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    flat = pa.array(np.frombuffer(b"".join(parts), "<i4"))
                    out.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_PIECE}" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _group_of(row: Column, counts: np.ndarray) -> Column:
    """A group within a length, by a hash of the row's number: even, however many rows share a length."""
    per = max(ROWS_PER_GROUP, -(-int(counts.sum()) // MOST_GROUPS))
    groups = F.array(*[F.lit(int(-(-n // per) or 1)) for n in counts])
    return F.pmod(F.xxhash64(row), F.get(groups, F.col("length").cast("int"))).cast("int")


def _places(chosen: dict[tuple, int], first: int) -> pd.DataFrame:
    """For each length and configuration, the ranks that go there and where that is.

    A configuration's bins are numbered in a row, its lengths stand in them in falling order.
    """
    rows, taken = [], {}
    for key, times in sorted(chosen.items()):
        offset = 0
        for length, each in key:
            low = taken.get(length, 0)
            taken[length] = low + each * times
            rows.append((length, low, each, first, offset))
            offset += length * each
        first += times
    found = pd.DataFrame(rows, columns=["length", "low", "each", "first", "offset"], dtype=np.int64)
    return found.sort_values(["length", "low"])


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`rows` with sequence_id and offset: sequences of at most `capacity` tokens, as few as found.

    `rows` is any table with a column `length` (0 < length <= capacity, not null); the columns it has are
    kept, but for ones named sequence_id or offset. The histogram of lengths, at most `capacity` numbers, goes to the
    driver, where the configurations are found (`configurations.pack`). Pieces of a length are
    interchangeable, so a piece's rank among those of its length tells its sequence: ranks are counted in
    groups of some hundred rows, whatever the length, and looked up in the list of configurations,
    whose size follows `capacity` too. Sequences are numbered from 0, offsets in one are gapless
    from 0; an empty table gives no rows.
    """
    own = [c for c in rows.columns if c.lower() not in ("sequence_id", "offset")]
    row, group, before, rank, spot = "_bf_row", "_bf_group", "_bf_before", "_bf_rank", "_bf_spot"
    rows = store(rows.select(*own, F.monotonically_increasing_id().alias(row)), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():  # at most one row a length
        counts[r["length"]] = r["count"]
    chosen, _ = pack_histogram(counts, capacity)
    table = _places(chosen, 0)
    # Ranks of all lengths on one line, so that one sorted search finds length and configuration.
    base = np.concatenate([[0], np.cumsum(counts)])[:-1]
    lengths = table["length"].to_numpy()
    keys = base[lengths] + table["low"].to_numpy()
    low, each, first, offset = (table[c].to_numpy() for c in ("low", "each", "first", "offset"))

    def spots(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(keys, base[length] + rank, side="right") - 1
        bin_, turn = np.divmod(rank - low[at], each[at])
        return pd.DataFrame({"sequence_id": first[at] + bin_, "offset": offset[at] + turn * length})

    grouped = rows.withColumn(group, _group_of(F.col(row), counts))
    sizes = grouped.groupBy("length", group).agg(F.count("*").alias(before))
    # One row a group, MOST_GROUPS and one a length at most; here they are added up.
    running = W.partitionBy("length").orderBy(group).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn(before, F.coalesce(F.sum(before).over(running), F.lit(0)))
    within = W.partitionBy("length", group).orderBy(row)
    ranked = grouped.join(starts, ["length", group]).withColumn(rank, F.col(before) + F.row_number().over(within) - 1)
    placed = ranked.withColumn(spot, F.pandas_udf(spots, "sequence_id long, offset long")("length", rank))
    return placed.select(*own, F.col(f"{spot}.sequence_id"), F.col(f"{spot}.offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, from placed pieces with their ids.

    A sequence holds at most the capacity, so a group is small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
