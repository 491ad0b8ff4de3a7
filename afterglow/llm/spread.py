"""Equi-joins that stay even when a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A right side of at most so many bytes, as counted before the join, is broadcast.
BROADCAST_BYTES = 32 << 20
#: A key is hot if it holds more than 1 in so many rows; there are fewer hot keys than that, whatever the size.
HOT_SHARE = 10_000
#: Parts that the rows of a hot key are dealt to.
SALTS = 64


def spread_join(rows: DataFrame, known: DataFrame, key: str, by: Column, size: Column | None = None, how: str = "inner") -> DataFrame:
    """`rows` joined with `known` on `key`.

    `known` has each key once and the column `n`, how many of the rows have that key; it is read several times, so it should be
    written. If `size` gives the bytes of its rows and they come to BROADCAST_BYTES at most, it is broadcast. Otherwise both sides are
    dealt by key, those of a hot key by key and salt: `by` spreads its rows, and its row of `known` is repeated for each salt. The hot keys
    themselves, fewer than HOT_SHARE, are broadcast. `how` is inner, left or left_semi. Null keys match nothing.
    """
    measured = known.agg(F.sum("n").alias("rows"), *([F.sum(size).alias("bytes")] if size is not None else [])).first()
    right = known.drop("n")
    if size is not None and (measured["bytes"] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(right), key, how)
    bound = max((measured["rows"] or 0) // HOT_SHARE, 1)
    hot = known.filter(F.col("n") > bound).select(key, F.lit(True).alias("__hot"))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(by, F.lit(SALTS)).cast("int")).otherwise(0)).drop("__hot")
    parts = F.when(F.col("n") > bound, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = known.withColumn("__salt", F.explode(parts)).drop("n")
    return left.join(right, [key, "__salt"], how).drop("__salt")
