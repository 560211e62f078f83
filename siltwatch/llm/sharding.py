"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of their keys. A balanced Feistel network permutes the
smallest even-bit domain that holds all numbers; a value outside ``0 .. rows - 1`` is
permuted again until it falls inside. Shard and slot of a row follow from its number
alone, and the row number from shard and slot: nothing is stored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import nonnull_text
from siltwatch.llm.numbering import numbered

ROUNDS = 6
FACTOR = 0x2545F4914F6CDD1D
"""Odd, under 2 ** 62, so that the SQL twin's products stay inside 128 bits."""


def round_keys(seed: int) -> list[int]:
    """Keys of the rounds, below 2 ** 31."""
    return np.random.default_rng(seed).integers(1, 2**31, ROUNDS).tolist()


def half_bits(rows: int) -> int:
    """Bits of each half of the smallest balanced domain for so many rows."""
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def _scramble(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = (half + np.uint64(key)) * np.uint64(FACTOR)
    x ^= x >> np.uint64(32)
    return (x * np.uint64(FACTOR)) >> np.uint64(64 - bits)


def _network(values: np.ndarray, keys: list[int], bits: int) -> np.ndarray:
    left, right = values >> np.uint64(bits), values & np.uint64((1 << bits) - 1)
    for key in keys:
        left, right = right, left ^ _scramble(right, key, bits)
    return (right << np.uint64(bits)) | left


def _walk(values: np.ndarray, rows: int, keys: list[int]) -> np.ndarray:
    bits = half_bits(rows)
    out = _network(values.astype(np.uint64), keys, bits)
    while (outside := np.flatnonzero(out >= rows)).size:
        out[outside] = _network(out[outside], keys, bits)
    return out.astype(np.int64)


def permuted(numbers: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """Place of each row number (0 to rows - 1) in the shuffle."""
    return _walk(numbers, rows, round_keys(seed))


def restored(places: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """Row number of each place: the rounds run backwards, since the halves are swapped at the end."""
    return _walk(places, rows, round_keys(seed)[::-1])


def _shard_and_slot(place: str, shards: int) -> tuple[Column, Column]:
    """Places are dealt in turn: shards differ by at most one row, and slots have no gap."""
    return F.expr(f"cast({place} % {shards} AS int)").alias("shard"), F.expr(f"{place} div {shards}").alias("slot")


def row_number(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """Global number of the row at a slot of a shard."""
    return int(restored(np.array([slot * shards + shard]), rows, seed)[0])


def _place(rows: int, seed: int, number: str) -> Column:
    run = F.pandas_udf(lambda n: pd.Series(permuted(n.to_numpy(), rows, seed)), "long")
    return run(F.col(number))


def _keys() -> list[Column]:
    data = nonnull_text().cast("binary")
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    ]


ORDER = ("doc_id", "size", "text_crc32")


def sharded(docs: DataFrame, shards: int = 16, seed: int = 13) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: the counts of shards differ by at most one, whatever keys, sources or
    texts repeat; equal texts are not kept together. ``size`` is the UTF-8 length of the
    text plus 1; a null text counts as empty (size 1, checksum 0). Rows are numbered by
    doc_id (null first), size and checksum; rows equal in all three are exchangeable, so
    the result depends on the rows alone, not on how they are stored. grown_shard is
    null, as under this law a further shard moves rows between all shards. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = numbered(docs.select(*_keys()), ORDER, "number")
    place = rows.withColumn("place", _place(rows.count(), seed, "number"))
    return place.select(*ORDER, F.lit("rows").alias("law"), *_shard_and_slot("place", shards), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 13) -> None:
    """Write whole rows as Parquet, ``shard=k`` folders in the order of slots.

    Rows are placed as by ``sharded``. Columns of ``docs`` named shard or slot are
    replaced. A shard is cut by ranges of slots over as many files as the session has
    shuffle partitions, so no task holds a whole shard.
    """
    own = docs.select(*_keys(), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]).alias("row"))
    rows = numbered(own, ORDER, "number")
    placed = rows.withColumn("place", _place(rows.count(), seed, "number"))
    placed = placed.select("row.*", *_shard_and_slot("place", shards))
    ranged = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)


_CRC = """list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(hex({data}), '..'), lambda h: CAST('0x' || h AS UBIGINT)),
  lambda c, b: xor(c >> 8, list_extract(crc_table.steps, CAST(xor(c, b) & 255 AS INTEGER) + 1)))"""
#: The table of the checksum's polynomial, one byte in eight steps.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda v: list_reduce([v::UBIGINT] || range(8)::UBIGINT[],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS steps
)"""


def crc_sql(data: str) -> str:
    """Unsigned crc32 of a blob in the SQL twins; needs ``CRC_TABLE`` among the tables."""
    return f"xor({_CRC.format(data=data)}, 4294967295::UBIGINT)::BIGINT"


def sql(shards: int = 16, seed: int = 13) -> str:
    """SQL twin: the same rounds in 128-bit integers, walking until all rows are inside."""
    two64 = "18446744073709551616::HUGEINT"
    factor = f"{FACTOR}::HUGEINT"
    value = "v"
    left, right = f"({value} // side)", f"({value} % side)"
    steps = []
    for k, key in enumerate(round_keys(seed)):
        x = f"((r{k} + {key}) * {factor}) % {two64}"
        y = f"((xor({x}, ({x}) // 4294967296::HUGEINT)) * {factor}) % {two64}"
        steps.append(f"SELECT *, r{k} AS l{k + 1}, xor(l{k}, ({y}) // ({two64} // side)) AS r{k + 1} FROM s{k}")
    nested = f"(SELECT *, {left} AS l0, {right} AS r0 FROM walk WHERE hops = 0 OR v >= rows)"
    for k, step in enumerate(steps):
        nested = f"({step.replace(f'FROM s{k}', f'FROM {nested} s{k}')})"
    return f"""
WITH RECURSIVE {CRC_TABLE},
keyed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {crc_sql("encode(coalesce(text, ''))")} AS text_crc32
  FROM documents, crc_table
),
counted AS (SELECT count(*) AS rows, CAST(pow(2, greatest(1, (length(bin(greatest(count(*) - 1, 1))) + 1) // 2)) AS HUGEINT) AS side FROM keyed),
walk AS (
  SELECT doc_id, size, text_crc32, rows, side, 0 AS hops,
    (row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1)::HUGEINT AS v
  FROM keyed, counted
  UNION ALL
  SELECT doc_id, size, text_crc32, rows, side, hops + 1, r{ROUNDS} * side + l{ROUNDS} FROM {nested} x
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(v % {shards} AS INTEGER) AS shard, CAST(v // {shards} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM walk WHERE hops > 0 AND v < rows
"""
