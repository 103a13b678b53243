"""Chat formatting: logged snapshots of growing conversations collapse into the longest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import same, store


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """A rolling hash per turn: conv_id, depth, hash_a, hash_b, n_turns.

    The prefix hash is the xor of two 64-bit hashes of (position, role, text) over the turns
    so far, so one running window gives it and nothing of a conversation is gathered.
    128 bits stand for the prefix: a chance match among 10^12 prefixes has odds below 10^-14.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("conv_id")
    hashed = turns.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("depth"))
    fields = [
        F.col("depth"),
        F.coalesce(F.concat(F.lit("r"), F.col("role")), F.lit("")),
        F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("")),
    ]
    return hashed.select(
        "conv_id", "depth",
        F.bit_xor(F.xxhash64(F.lit("a"), *fields)).over(so_far).alias("hash_a"),
        F.bit_xor(F.xxhash64(F.lit("b"), *fields[::-1])).over(so_far).alias("hash_b"),
        F.count("*").over(whole).alias("n_turns"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of conversations that are not a prefix of a longer one.

    Of equal conversations the smallest conv_id stays, null before all others. Proper prefixes are made distinct
    (combined before the shuffle), so a first turn that all share is one row; whole
    conversations are made distinct before the anti join for the same reason.
    """
    hashed = store(prefix_hashes(turns), "prefixes")
    key = ["depth", "hash_a", "hash_b"]
    # Of a struct, because the smallest of plain ids passes over nulls.
    smallest = F.min(F.struct("conv_id"))["conv_id"].alias("conv_id")
    whole = hashed.filter(F.col("depth") == F.col("n_turns")).groupBy(*key).agg(smallest)
    proper = hashed.filter(F.col("depth") < F.col("n_turns")).groupBy(*key).agg(F.lit(1).alias("one"))
    return whole.join(proper, key, "left_anti").select("conv_id", F.col("depth").alias("n_turns"))


def collapse(turns: DataFrame, template: tuple[str, str, str] = ("<|", "|>\n", "\n<|end|>\n")) -> DataFrame:
    """Maximal conversations, rendered: conv_id, n_turns, rendered.

    `turns` has conv_id, turn, role, text. A turn is rendered as role and text between the
    three parts of `template`. Turns sort by turn (null first), ties by role, then text. A
    null role or text is rendered empty but is not the same as an empty one; a null conv_id
    is a conversation of its own, the smallest; rows repeated whole count once; other columns
    are not read; an empty table gives no rows.
    """
    before, between, after = template
    turns = turns.select("conv_id", "turn", "role", "text").distinct()
    kept = store(maximal(turns), "maximal")
    said = turns.join(
        kept.withColumnRenamed("conv_id", "kept_id"), same(F.col("conv_id"), F.col("kept_id"))
    )
    return said.groupBy("conv_id").agg(
        F.max("n_turns").cast("bigint").alias("n_turns"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
                lambda t: F.concat(
                    F.lit(before), F.coalesce(t["role"], F.lit("")), F.lit(between),
                    F.coalesce(t["text"], F.lit("")), F.lit(after),
                ),
            ),
            "",
        ).alias("rendered"),
    )
