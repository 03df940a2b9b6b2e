"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.session import broadcast_limit, estimated_bytes, stage

# A salt for so many bytes of facts, between these bounds.
SALT_BYTES = 1 << 30
LEAST_SALTS, MOST_SALTS = 16, 4096
# Rows per bitmap, as Spark's bitmap functions have it, and the most bytes of bitmaps that are broadcast.
BITMAP_ROWS, BITMAP_BYTES = 1 << 15, 16 << 20


def salt_count(facts: DataFrame) -> int:
    """Parts a key is cut into: enough that a third of the facts in one key is no more than about ``SALT_BYTES`` each."""
    return max(LEAST_SALTS, min(MOST_SALTS, estimated_bytes(facts) // SALT_BYTES))


def lookup(facts: DataFrame, dim: DataFrame, on: str, spread: Column, how: str = "inner", salts: int | None = None) -> DataFrame:
    """Join ``facts`` to a ``dim`` that is unique on ``on``.

    A dimension whose estimated size is within the session's broadcast threshold is broadcast. Beyond
    it both sides are salted: ``spread`` cuts every key of ``facts`` into ``salts`` parts, by default by the estimated size
    of ``facts``, and the narrow dimension is repeated once per part, so a key with a third of all rows still spreads.
    """
    limit = broadcast_limit(facts.sparkSession)
    if estimated_bytes(dim) <= limit:
        return facts.join(F.broadcast(dim), on, how)
    salts = salts or salt_count(facts)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def numbered_rows(rows: DataFrame, kept: DataFrame, number: str, within: str | None = None) -> DataFrame:
    """The rows of ``rows`` whose ``number`` is in ``kept``: a semi-join that leaves wide rows where they are.

    Numbers are at least 0 and run closely, over all rows or ``within`` each value of a column, such as a file. The kept ones become
    bitmaps of about a bit a row, which are broadcast up to ``BITMAP_BYTES`` of them; beyond that the rows are shuffled.
    """
    place = [] if within is None else [within]
    names = [*place, "_bucket"]
    bucket, bit = F.shiftright(number, 15), F.col(number).bitwiseAND(F.lit(BITMAP_ROWS - 1))
    there = kept.select(*place, number).dropna().select(*place, bucket.alias("_bucket"), bit.alias("_bit"))
    maps = there.groupBy(*names).agg(F.bitmap_construct_agg("_bit").alias("_map"), F.max("_bit").alias("_last"))
    # the last bytes of a bitmap that hold no row are left out
    held = F.substring("_map", F.lit(1), (F.shiftright("_last", 3) + 1).cast("int"))
    maps = stage(maps.select(*names, held.alias("_map")), "rows")
    if (maps.agg(F.sum(sum(map(F.octet_length, place), F.octet_length("_map") + 16))).first()[0] or 0) > BITMAP_BYTES:
        return rows.join(kept.select(*place, number), [*place, number], "left_semi").select(*rows.columns)
    byte = F.conv(F.hex(F.substring("_map", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("_bucket", bucket).join(F.broadcast(maps), names)
    return met.filter(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*rows.columns)
