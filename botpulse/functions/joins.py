"""Joins that depend on a checked size, and on counted hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 8 << 20  # bytes
SPLIT_FROM = 256 << 20  # bytes of the probe side from which hot keys are looked for
SHARES = 256  # a key with more than one in so many rows is hot: there are fewer hot keys than this


def estimated_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate (for a stored table its files; joins are overestimated). Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def only_bots(events: DataFrame, bots: DataFrame, bot_col: str, spread: list[str]) -> DataFrame:
    """The events whose ``bot_col`` is a ``prompt_id`` of ``bots`` (a semi-join).

    Ids estimated below ``BROADCAST_LIMIT`` are broadcast, so other bots' events are left out in the scan's
    own stage. Beyond it both sides are shuffled on the bot; the kept events are then dealt out anew by
    ``spread``, so that a hot bot's events don't stay together for what follows and the join can be split.
    """
    ids = bots.select(F.col("prompt_id").alias(bot_col)).distinct()
    if estimated_bytes(ids) <= BROADCAST_LIMIT:
        return events.join(F.broadcast(ids), bot_col, "left_semi")
    return events.join(ids, bot_col, "left_semi").repartition(*spread)


def hot_keys(rows: DataFrame, key: str, shares: int = SHARES) -> list:
    """The values of ``key`` held by more than one in ``shares`` rows (fewer than ``shares`` values). Null is never one.

    Two counts, combined map-side; only the hot values reach the driver.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.where(F.col("n") * shares > rows.count()).select(key).collect()]


def _one_of(key: str, values: list) -> Column:
    return F.coalesce(F.col(key).isin(values), F.lit(False))


def split_join(rows: DataFrame, build: DataFrame, key: str, how: str = "inner", hot: list | None = None,
               shares: int = SHARES, limit: int = BROADCAST_LIMIT, split_from: int = SPLIT_FROM) -> DataFrame:
    """``rows.join(build, key, how)`` (inner or left) for a ``rows`` with hot keys; the same rows in any order.

    A ``build`` estimated below ``limit`` bytes is broadcast. Beyond it, once ``rows`` is estimated above ``split_from``
    bytes, the hot keys are counted (or taken from ``hot``) and their rows set apart: they meet the
    build rows of these few keys, which are broadcast if their counted bytes are below ``limit``; else the hot rows are
    dealt out over ``shares`` salts and the build rows of the hot keys copied to each salt, so that no task takes
    more than its share of a key. All other rows are shuffled on the key: none of their keys is in more than
    one in ``shares`` rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join {how!r}")
    if hot is None:
        if estimated_bytes(build) <= limit:
            return rows.join(F.broadcast(build), key, how)
        if estimated_bytes(rows) <= split_from:
            return rows.join(build, key, how)
        hot = hot_keys(rows, key, shares)
    if not hot:
        return rows.join(build, key, how)
    columns = [key, *[c for c in rows.columns if c != key], *[c for c in build.columns if c != key]]
    cold = rows.where(~_one_of(key, hot)).join(build.where(~_one_of(key, hot)), key, how).select(*columns)
    few = build.where(_one_of(key, hot))
    if _counted_bytes(few) <= limit:
        warm = rows.where(_one_of(key, hot)).join(F.broadcast(few), key, how)
    else:
        # by content and task, so that a repeated task deals its rows out as before
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.spark_partition_id()), F.lit(shares))
        salted = rows.where(_one_of(key, hot)).withColumn("salt_", salt.cast("int"))
        copied = few.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        warm = salted.join(copied, [key, "salt_"], how)
    return cold.unionByName(warm.select(*columns))


def _counted_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``: text and binary by length, everything else 16 bytes a value. Runs one aggregate."""
    def width(field) -> Column:
        sized = field.dataType.typeName() in ("string", "binary")
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16 if sized else F.lit(16)

    total = reduce(lambda a, b: a + b, map(width, df.schema.fields), F.lit(0).cast("long"))
    return int(df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0])
