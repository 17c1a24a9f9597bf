"""Row-level joins that one hot key cannot stall.

A join on a key deals all rows of a key to one task.  Here the key column is
summarised first by a bounded, mergeable frequent-items sketch (one scan of the
key columns alone).  Keys the sketch reports with more rows than an average
partition holds are hot: their fact rows are dealt over ``FINER`` salts for every
partition they fill, and only their dimension rows are repeated, once per salt.  All
other keys keep salt 0 and are joined as usual, in the same shuffle.

The sketch only places rows; the join compares the keys themselves, so its
estimates never change a result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.sqltext import ident
from sluice.operators.dimension import local_rows

#: Hot keys at most: with a share above 1 / MOST_HOT of the rows there cannot be more.
MOST_HOT = 1000
MATCHED = "matched"
#: Salts per partition that a hot key fills: many small pieces spread more evenly than a few large ones.
FINER = 8
_HASH, _SALTS, _SALT = "__key_hash", "__key_salts", "__key_salt"


def _key_hash(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """Hash of the key values in the given types (a value outside its type cannot match)."""
    return F.xxhash64(*[F.col(ident(k)) if df.schema[k].dataType == t else F.col(ident(k)).try_cast(t)
                        for k, t in zip(keys, types)])


def hot_keys(df: DataFrame, keys: Sequence[str], pieces: int | None = None) -> list[tuple[int, int]]:
    """``(key hash, salts)`` of the keys that fill more than one of ``pieces`` partitions.

    One aggregate with constant state per task; at most ``MOST_HOT`` rows reach the driver.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(2, min(pieces, MOST_HOT))
    found = (df.select(_key_hash(df, keys, [df.schema[k].dataType for k in keys]).alias(_HASH))
             .agg(F.expr(f"approx_top_k({_HASH}, {most}, {16 * most}) AS top"), F.count(F.lit(1)).alias("n")).first())
    return [(r["item"], -(-FINER * r["count"] * pieces // found["n"])) for r in found["top"] or []
            if r["count"] * most > found["n"] and r["count"] * pieces > found["n"]]


def skew_join(facts: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left",
              pieces: int | None = None, hot: list[tuple[int, int]] | None = None) -> DataFrame:
    """Equi-join on columns of the same names; hot keys of ``facts`` are spread by salts.

    ``hot``: what ``hot_keys`` says of the keys, where that is known already.  ``how``: ``left``, ``inner``, ``left_semi`` or ``left_anti``.  The salt of a
    fact row is a hash of its columns, so a task that runs again deals the same
    rows to the same place; equal rows share a salt.  NULL keys match nothing and
    are spread like any other hot key.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how}")
    keys = list(keys)
    hot = hot_keys(facts, keys, pieces) if hot is None else hot
    if not hot:
        return facts.join(other, keys, how)
    table = F.broadcast(local_rows(facts.sparkSession, hot, f"{_HASH} bigint, {_SALTS} bigint"))  # MOST_HOT rows at most
    types = [facts.schema[k].dataType for k in keys]

    def with_salts(df):
        return (df.withColumn(_HASH, _key_hash(df, keys, types)).join(table, _HASH, "left")
                .withColumn(_SALTS, F.coalesce(_SALTS, F.lit(1).cast("bigint"))).drop(_HASH))

    spread = [F.col(ident(f.name)) for f in facts.schema if not re.search("map<|variant", f.dataType.simpleString())]
    left = with_salts(facts).withColumn(_SALT, F.pmod(F.xxhash64(*spread), F.col(_SALTS))).drop(_SALTS)
    right = with_salts(other).withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(_SALTS) - 1))).drop(_SALTS)
    return left.join(right, [*keys, _SALT], how).drop(_SALT)


def enrich(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, columns: Sequence[str] | None = None,
           pieces: int | None = None) -> DataFrame:
    """Every fact row with its dimension columns and ``matched``.

    A left join: a fact row without a dimension row keeps NULLs and
    ``matched = false``; a key that stands several times in the dimension gives
    as many rows.  ``columns`` are the dimension columns to add, default all.
    """
    dim_key = dim_key or key
    columns = [c for c in dim.columns if c != dim_key] if columns is None else list(columns)
    clash = sorted({*columns, MATCHED} & set(facts.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    side = dim.select(F.col(ident(dim_key)).alias(key), *[F.col(ident(c)) for c in columns], F.lit(True).alias(MATCHED))
    joined = skew_join(facts, side, [key], "left", pieces)
    return joined.select(*[F.col(ident(c)) for c in facts.columns], *[F.col(ident(c)) for c in columns],
                         F.coalesce(MATCHED, F.lit(False)).alias(MATCHED))


def enrichment_audit(facts: DataFrame, enriched: DataFrame, key: str) -> DataFrame:
    """One row: rows before and after, unmatched rows and keys, rows that repeated dimension keys added.

    Both tables are reduced to counts (the unmatched keys are counted once each);
    the join is not made again.
    """
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    nothing = F.lit(None).cast("bigint")
    after = enriched.groupBy(F.when(~F.col(MATCHED), F.col(key)).alias("_miss"), MATCHED).agg(F.count(F.lit(1)).alias("_out"))
    sides = (facts.agg(F.count(F.lit(1)).alias("_in")).select("_in", nothing.alias("_out"), nothing.alias("_lost"), nothing.alias("_key"))
             .unionByName(after.select(nothing.alias("_in"), "_out", F.when(~F.col(MATCHED), F.col("_out")).alias("_lost"),
                                       F.when(F.col("_miss").isNotNull(), 1).cast("bigint").alias("_key"))))
    return sides.agg(count("_in").alias("rows_before"), count("_out").alias("rows_after"), count("_lost").alias("unmatched_rows"),
                     count("_key").alias("unmatched_keys")).withColumn("fan_out_rows", F.col("rows_after") - F.col("rows_before"))


__all__ = ["enrich", "enrichment_audit", "hot_keys", "skew_join"]
