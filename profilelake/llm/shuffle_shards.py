"""Reproducible shards: a keyed Feistel permutation of global row numbers.

Every row has a global number that follows from the table's content alone: rows are
ordered by a fixed hash bucket of their key, then by the key (id, size, checksum).
A generalised Feistel network over ``a x b`` cells permutes the numbers; a number
that lands at or beyond the row count is permuted again until it is below it (cycle
walking), so the permutation is one of exactly ``count`` numbers. Position ``p`` is
slot ``p // shards`` of shard ``p % shards``: counts differ by one at most, slots
have no gaps, and both directions are computed, never looked up: ``positions`` gives
the place of a row number, ``row_numbers`` the row number of a place.

Texts stay where they are: only (id, size, checksum) is shuffled, equal rows as one
row with a count. A hot id is one row too, and its numbers are dealt out in blocks.

Cases: null texts have a size of 16 and the checksum of nothing; null ids are rows
like others; repeated rows are numbered next to each other, each with a place of its
own (they are alike, so it does not matter which has which); other columns are left
aside by ``assign``, whatever their names, and kept by ``shuffled``; an empty table
gives no row; texts of any length count whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import staged

SHARDS = 40
KEY = 20_260_701
ROUNDS = 8
ROW_BYTES = 16  # what a row takes beside its text
BUCKETS = 4096  # of the row order; a fixed number, so numbers do not depend on the cluster
BLOCK = 1 << 16  # numbers of equal rows that one task unfolds

_LAW = "rows"


def _round(value: np.ndarray, key: int) -> np.ndarray:
    """Keyed 64-bit mixing of one half."""
    x = (value.astype(np.uint64) + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _keys(key: int) -> list[int]:
    seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64)
    return [int(k) >> 1 for k in _round(seeds, key & (1 << 62) - 1)]


def _sides(count: int) -> tuple[int, int]:
    """Sides of the smallest near-square of cells that holds ``count`` numbers."""
    a = max(1, math.isqrt(count - 1) + 1 if count > 1 else 1)
    return a, max(1, -(-count // a))


def _forth(numbers: np.ndarray, a: int, b: int, keys: list[int]) -> np.ndarray:
    left, right = numbers // b, numbers % b
    for i, k in enumerate(keys):
        if i % 2:
            right = (right + (_round(left, k) % np.uint64(b)).astype(np.int64)) % b
        else:
            left = (left + (_round(right, k) % np.uint64(a)).astype(np.int64)) % a
    return left * b + right


def _back(numbers: np.ndarray, a: int, b: int, keys: list[int]) -> np.ndarray:
    left, right = numbers // b, numbers % b
    for i, k in reversed(list(enumerate(keys))):
        if i % 2:
            right = (right - (_round(left, k) % np.uint64(b)).astype(np.int64)) % b
        else:
            left = (left - (_round(right, k) % np.uint64(a)).astype(np.int64)) % a
    return left * b + right


def _walk(step, numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    a, b = _sides(count)
    keys = _keys(key)
    out = np.asarray(numbers, dtype=np.int64).copy()
    walking = np.ones(len(out), bool)
    while walking.any():
        out[walking] = step(out[walking], a, b, keys)
        walking = out >= count
    return out


def positions(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """Where row numbers below ``count`` stand after the shuffle."""
    return _walk(_forth, numbers, count, key)


def row_numbers(places: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """The row numbers that stand at ``places``: the inverse of ``positions``."""
    return _walk(_back, places, count, key)


def position(number: Column, count: int, key: int = KEY) -> Column:
    @F.arrow_udf(T.LongType())
    def place(column: pa.Array) -> pa.Array:
        return pa.array(positions(column.to_numpy(zero_copy_only=False), count, key), pa.int64())

    return place(number)


def _sized(documents: DataFrame, id_col: str, text_col: str) -> list[Column]:
    raw = F.coalesce(documents[text_col].cast("binary"), F.lit(b""))
    return [
        documents[id_col].cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ]


def numbered(keyed: DataFrame) -> tuple[DataFrame, int]:
    """(the distinct keys with how many rows have each and the first one's number, row count)."""
    keys = keyed.columns
    order = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")
    counted = staged(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select("*", order), "counted")
    totals = {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    begins = [0]
    for bucket in range(BUCKETS):
        begins.append(begins[-1] + totals.get(bucket, 0))
    starts = F.split(F.lit(",".join(map(str, begins))), ",").cast("array<bigint>")
    columns = ", ".join(f"`{k}`" for k in keys)
    before = F.expr(
        f"coalesce(sum(n) OVER (PARTITION BY bucket ORDER BY {columns} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    first = counted.withColumn("before", before)
    return first.select(*keys, "n", (F.get(starts, F.col("bucket")) + F.col("before")).alias("first")), begins[-1]


def _unfolded(first: DataFrame) -> DataFrame:
    """One row per number. Keys of many rows are cut into blocks that other tasks unfold."""
    keys = [c for c in first.columns if c not in ("n", "first")]
    one = first.filter("n = 1").select(*keys, F.col("first").alias("row_number"))
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(BLOCK).cast("bigint")))
    many = first.filter("n > 1").select(*keys, "n", "first", blocks.alias("at")).hint("rebalance")
    last = F.least(F.col("at") + BLOCK, F.col("n")) - 1
    numbers = F.explode(F.sequence(F.col("at"), last)).alias("k")
    return one.unionAll(
        many.select(*keys, "first", numbers).select(*keys, (F.col("first") + F.col("k")).alias("row_number"))
    )


def assign(
    documents: DataFrame,
    shards: int = SHARDS,
    key: int = KEY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its size, checksum, row number, shard and slot."""
    first, count = numbered(documents.select(*_sized(documents, id_col, text_col)))
    at = position(F.col("row_number"), max(count, 1), key).alias("position")
    return _unfolded(first).select("*", at).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(_LAW).alias("law"),
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def shuffled(
    documents: DataFrame,
    shards: int = SHARDS,
    key: int = KEY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows with all their columns in ``row``, with (shard, slot), dealt by shard in slot order.

    Rows are told apart by all their columns, so equal rows share one entry while
    they are matched. Each partition of the result holds whole shards, ready to be
    written as one file per shard.
    """
    whole = F.struct(*(documents[c] for c in documents.columns))
    named = documents.select(
        *_sized(documents, id_col, text_col), F.xxhash64(whole).alias("content"), whole.alias("row")
    )
    keys = ["doc_id", "size", "text_crc32", "content"]
    first, count = numbered(named.select(*keys))
    at = position(F.col("row_number"), max(count, 1), key).alias("position")
    places = _unfolded(first).select("*", at).select(
        *keys,
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("bigint").alias("slot"),
    )
    distinct = named.groupBy(*keys).agg(F.first("row").alias("row"))
    met = [F.col(f"p.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    joined = places.alias("p").join(distinct.alias("d"), met).select("p.shard", "p.slot", "d.row")
    return joined.repartition("shard").sortWithinPartitions("shard", "slot")
