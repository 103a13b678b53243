"""N-gram Jaccard join over prefix trees of globally ordered shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, same, store
from tidemark.llm.components import components

SHINGLE = 5
#: Two sets link when NUM * their union <= DEN * their intersection.
NUM, DEN = 80, 100
#: Sets of one tree: bounds the task of a set with very many candidates.
TREE_SETS = 256


# --- sets ---------------------------------------------------------------------


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct 5-word shingles; of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and ASCII space
    if not words:
        return np.zeros(0, np.int64)
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = max(len(words) - SHINGLE + 1, 1)
    out = np.full(n, min(len(words), SHINGLE), np.uint64)
    for k in range(min(len(words), SHINGLE)):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((out ^ (out >> np.uint64(29))).view(np.int64))


def set_hash(tokens: np.ndarray) -> int:
    """One 64-bit number for a set."""
    x = tokens.view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(30))
    return int(np.bitwise_xor.reduce(x * (x | np.uint64(1))).view(np.int64)) if len(x) else 0


def least_overlap(n: int) -> int:
    """Shingles that any set of similarity NUM / DEN or more has in common with one of n."""
    return -(-n * NUM // DEN)


def surplus(n: int) -> int:
    """Hashes of the sample beyond those a set may have alone."""
    return min(least_overlap(n), 1 + -(-n // 20))


def sample_length(n: int) -> int:
    """First hashes that enter the pruning count: the prefix, and a twentieth of the set."""
    return n - least_overlap(n) + surplus(n)


def _sets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, n, node (hash of the set), the sample (smallest hashes), and
    how many of the sample any partner must have in its own. Ids stay out of Python, whose frames
    would turn longs beside a null into doubles."""

    def of_texts(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t) for t in texts]
        return pd.DataFrame({
            "n": [len(s) for s in sets], "node": [set_hash(s) for s in sets],
            "sample": [s[: sample_length(len(s))] for s in sets],
            "common": [surplus(least_overlap(len(s))) for s in sets],
        })

    found = F.pandas_udf(of_texts, "n int, node long, sample array<long>, common int")("text")
    return docs.select("doc_id", "text_hash", found.alias("set")).select("doc_id", "text_hash", "set.*")


def _single(tokens: DataFrame) -> DataFrame:
    """How many of a node's tokens no other node has: node, n_single. `tokens`: node, token.

    A token whose smallest and largest node are one has that node only. Minima combine
    before the shuffle, so a token that all documents share is one row per task.
    """
    held = tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return held.filter("low = high").groupBy(F.col("low").alias("single")).agg(F.count("*").alias("n_single"))


def _without_single(sets: DataFrame, tokens: DataFrame, most: Column) -> DataFrame:
    """Rows of `sets` with at most `most` tokens that no other node has."""
    counted = sets.join(_single(tokens), F.col("node") == F.col("single"), "left")
    return counted.filter(F.coalesce("n_single", F.lit(0)) <= most).drop("single", "n_single")


def candidates(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Sets that can have a partner: node, n, tokens. Exact: whom it drops has none.

    If sets of x and y shingles have all but x - a and y - a in common, their first x - a + k and
    y - a + k hashes have k in common (both sorted alike). A partner of a set of n has 4n / 5 or
    more shingles, so their samples share `surplus` of that many hashes. A set with
    fewer shared hashes in its sample is out before its other hashes ever move. The rest are
    counted over all their hashes: a set needs four fifths of them shared.
    """
    n = F.col("n")
    classes = sets.filter("n > 0").groupBy("node", "n").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("one"),
        F.max(F.size("sample") - F.col("common")).alias("most"),
    )
    slack = n - F.ceil(n * NUM / DEN).cast("int")  # tokens a set may have alone
    sample = sets.filter("n > 0").select("node", F.explode("sample").alias("token"))
    left = _without_single(classes, sample, F.col("most"))
    wanted = store(left.select("node", "one.doc_id", "one.text_hash"), "wanted").select(
        F.col("node").alias("wanted"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h")
    )
    texts = docs.join(
        broadcast_if_small(wanted.select("d", "h")),
        same(F.col("doc_id"), F.col("d")) & same(F.col("text_hash"), F.col("h")), "left_semi",
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_set(t) for t in batch["text"]]
            yield pd.DataFrame({
                "node": [set_hash(s) for s in found], "n": [len(s) for s in found], "tokens": found,
            })

    full = texts.select("text").mapInPandas(rows, "node long, n int, tokens array<long>")
    full = store(full.dropDuplicates(["node"]), "full")
    return store(_without_single(full, full.select("node", F.explode("tokens").alias("token")), slack), "full")


def ordered(full: DataFrame) -> DataFrame:
    """Every set's shared tokens in global order, rarest first: node, n, n_single, tokens, central.

    A token that no other set has would come first in this order and matches nothing, so it is
    only counted. `central` is how many sets have a token of this one, on average. A set is
    gathered whole, as it was read, never a token's sets.
    """
    spread = full.select("node", "n", F.explode("tokens").alias("token"))
    often = spread.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("often")).filter("often > 1")
    return (
        spread.join(often, F.col("token") == F.col("t"))
        .groupBy("node", "n")
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("often", "token"))), lambda x: x["token"]).alias("tokens"),
            F.sum("often").alias("uses"),
        )
        .withColumn("n_single", F.col("n") - F.size("tokens"))
        .withColumn("central", (F.col("uses") + F.col("n_single")) / F.col("n"))
    )


# --- tree ---------------------------------------------------------------------


class PrefixTree:
    """Ordered sets in a trie, as sorted lists with the length of the prefix that each shares
    with the one before: a walk along the lists visits the trie's nodes depth first, and the
    shared length says how much of the path, and of its overlap, is still valid."""

    STEP = 64  # tokens counted between two looks at the bound

    def __init__(self, names: list[int], sets: list[np.ndarray], sizes: list[int]):
        # Any order that keeps common prefixes together serves; bytes compare fast.
        order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        self.names = [names[i] for i in order]
        self.sets = [sets[i] for i in order]
        self.sizes = [sizes[i] for i in order]
        self.shared = [0]
        for x, y in zip(self.sets, self.sets[1:], strict=False):
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            self.shared.append(int(differ[0]) if len(differ) else m)

    def links(self, tokens: np.ndarray, size: int) -> list[int]:
        """Names of the sets that link with one of `size` shingles, of which `tokens` are shared."""
        probe = np.sort(tokens)
        found = []
        path = np.zeros(1, np.int64)  # path[d]: overlap of the first d tokens of the path
        for name, own, own_size, shared in zip(self.names, self.sets, self.sizes, self.shared, strict=True):
            # A path left early is shorter than the prefix shared with the next set.
            path = path[: min(shared, len(path) - 1) + 1]
            needed = -(-NUM * (size + own_size) // (NUM + DEN))
            while True:
                depth = len(path) - 1
                rest = len(own) - depth
                if path[-1] + min(rest, len(probe) - path[-1]) < needed or not rest:
                    break
                part = own[depth : depth + self.STEP]
                at = np.minimum(np.searchsorted(probe, part), len(probe) - 1)
                path = np.concatenate([path, path[-1] + np.cumsum(probe[at] == part)])
            if len(path) - 1 == len(own) and path[-1] >= needed:
                found.append(name)
        return found


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. Sets b with one a form its trees, of at most about
    `TREE_SETS` sets each, so that a set with any number of candidates is many tasks."""
    counts = pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count("*") / TREE_SETS).alias("trees"))
    salted = pairs.join(counts, F.col("a") == F.col("of")).select(
        "a", "b", F.pmod(F.xxhash64("b"), "trees").alias("tree")
    )
    own = sets.select("node", "n", "tokens")
    probes = salted.select("a", "tree").distinct().join(own, F.col("a") == F.col("node")).select(
        F.col("a").alias("probe"), F.col("tree").alias("of_tree"), F.col("n").alias("size"), F.col("tokens").alias("set")
    )
    members = salted.join(own, F.col("b") == F.col("node")).select("a", "tree", "b", "n", "tokens")

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            tree = PrefixTree(right["b"].tolist(), list(right["tokens"]), right["n"].tolist())
            probe = left.iloc[0]
            out = [(int(probe["probe"]), b) for b in tree.links(probe["set"], int(probe["size"]))]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    grouped = probes.groupBy("probe", "of_tree").cogroup(members.groupBy("a", "tree"))
    return grouped.applyInPandas(match, "a long, b long")


# --- join ---------------------------------------------------------------------


def _near_size(x: str, y: str) -> Column:
    """Sizes that leave a similarity of 0.8 possible."""
    return F.least(x, y) * DEN >= F.greatest(x, y) * NUM


def links(full: DataFrame) -> DataFrame:
    """Links (a, b) of the given sets, enough of them to connect whatever all links connect.

    Linked sets share a token among the first n / 5 + 1 of each, rarest first. So the sets
    that have one rare token are each other's candidates. First every set meets one other: the
    most central set of its tokens' lists, where it meets it most often. A copy differs
    from the original less than from other copies, so that connects most of a group with a
    pair per copy. Then only pairs whose sets are still apart are left. A pair of n and n_b
    shingles needs `need` in common, so their first n - need + 1 and n_b - need + 1 share a token;
    the pairs that do, by the places of the token, are all verified, so no connection is missed.
    """
    sets = store(ordered(full), "ordered")
    prefix = F.col("n") - F.ceil(F.col("n") * NUM / DEN).cast("int") + 1 - F.col("n_single")
    rare = store(
        sets.filter(prefix > 0).select(
            "node", "n", "n_single", "central", F.size("tokens").alias("m"),
            F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("at", "token"),
        ),
        "rare",
    )
    middle = rare.groupBy(F.col("token").alias("t")).agg(F.max(F.struct("central", "node", "n")).alias("hub"))
    met = (
        rare.join(middle, F.col("token") == F.col("t"))
        .select("node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
        .filter(F.col("node") != F.col("hub")).filter(_near_size("n", "hub_n"))
        .groupBy("node", "hub").agg(F.count("*").alias("times"))
        .groupBy("node").agg(F.max(F.struct("times", "hub")).alias("best"))
    )
    tried = store(met.select(F.col("best.hub").alias("a"), F.col("node").alias("b")), "tried")
    first = store(verified(tried, sets), "linked")
    labels = components(first)

    placed = rare.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "node", "n", "n_single", "m", "at", "token", F.coalesce("component", "node").alias("part")
    )
    parted = placed.groupBy(F.col("token").alias("t")).agg(F.min("part").alias("low"), F.max("part").alias("high"))
    apart = store(
        placed.join(parted.filter("low < high"), F.col("token") == F.col("t")).drop("t", "low", "high"), "apart"
    )
    other = apart.select(*[F.col(c).alias(f"{c}_b") for c in apart.columns])
    need = F.ceil((F.col("n") + F.col("n_b")) * NUM / (NUM + DEN))
    # Both sets have the token early enough, and with what they have before and after it can
    # reach what they need.
    early = (F.col("n_single") + F.col("at") <= F.col("n") - need) & (
        F.col("n_single_b") + F.col("at_b") <= F.col("n_b") - need
    )
    most = F.least("at", "at_b") + F.least(F.col("m") - F.col("at"), F.col("m_b") - F.col("at_b"))
    left = (
        apart.join(other, (F.col("token") == F.col("token_b")) & (F.col("node") < F.col("node_b")))
        .filter((F.col("part") != F.col("part_b")) & _near_size("n", "n_b") & early & (most >= need))
        .select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
    )
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left = store(left.join(tried.select(*pair), ["a", "b"], "left_anti"), "pairs")
    return first.unionByName(verified(left, sets))


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Component of every document under Jaccard similarity of 0.8 of its 5-word shingles.

    Returns per row of `docs` (doc_id, text): doc_id, text_hash, n_shingles, part (a number for
    the component; null without words), component_id, the smallest doc_id that links reach. A-Z
    compare in lower case; a text of fewer than 5 words is one shingle; one without words, or
    null, has none and links with nothing.

    Equal sets are one node from the start, known by a 64-bit hash of the set; shingles are 64-bit
    hashes too, so results are exact but for hash collisions. Sets without a possible
    partner go first (`candidates`); the rest are joined by `links`.

    Copies in any number cost a row each. Repeated rows get the same row each; rows that share
    an id but not a text are judged by their texts; a null id comes back as a null, unless
    its group has an id; other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash")
    )
    sets = store(_sets(docs), "sets")
    found = components(links(candidates(sets, docs)))
    nodes = sets.filter("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("least_id"))
    grouped = nodes.join(found.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").withColumn(
        "part", F.coalesce("component", "node")
    )
    least = grouped.groupBy(F.col("part").alias("p")).agg(F.min("least_id").alias("component_id"))
    named = store(
        grouped.join(least, F.col("part") == F.col("p")).select(
            F.col("node").alias("of"), F.col("n").alias("of_n"), "part", "component_id"
        ),
        "named",
    )
    linked = sets.filter("n > 0").join(named, (F.col("node") == F.col("of")) & (F.col("n") == F.col("of_n"))).select(
        "doc_id", "text_hash", F.col("n").cast("bigint").alias("n_shingles"), "part", "component_id"
    )
    empty = sets.filter("n = 0").select(
        "doc_id", "text_hash", F.lit(0).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("part"),
        F.col("doc_id").alias("component_id"),
    )
    return linked.unionByName(empty)
